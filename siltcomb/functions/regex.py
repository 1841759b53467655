"""Python regular expressions in terms of the JVM's, where both surely agree.

Patterns follow Python's ``re`` on text: Unicode classes, no multi-line mode, ignoring case unless
asked otherwise. What can't be carried over safely is left to Python workers (:class:`NeedsPython`).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

WORD = r"\p{L}\p{N}_"
SPACE = r"\s\x1c-\x1f"
_BORDER = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"
_NO_BORDER = rf"(?:(?<=[{WORD}])(?=[{WORD}])|(?<![{WORD}])(?![{WORD}]))"
_OUTSIDE = {"w": f"[{WORD}]", "W": f"[^{WORD}]", "s": f"[{SPACE}]", "S": f"[^{SPACE}]", "b": _BORDER, "B": _NO_BORDER, "Z": r"\z"}
_INSIDE = {"w": WORD, "s": SPACE, "b": r"\x08"}
_SAME = set("dDAfnrtv")


class NeedsPython(Exception):
    """The pattern, or what is asked of it, has no certain equivalent in the JVM."""


@dataclass(frozen=True)
class Pattern:
    """A checked pattern: its Python source and flags, the JVM form if there is one, and the least match length."""

    source: str
    case_sensitive: bool
    jvm: str | None
    least: int

    @property
    def spans_in_jvm(self) -> bool:
        """Splitting and extracting agree with finditer only if no match is empty."""
        return self.jvm is not None and self.least >= 1

    def compiled(self) -> re.Pattern:
        return re.compile(self.source, 0 if self.case_sensitive else re.IGNORECASE)


def checked(source: str, case_sensitive: bool = False) -> Pattern:
    """Compile and translate; ``re.error`` if the pattern is wrong."""
    flags = 0 if case_sensitive else re.IGNORECASE
    re.compile(source, flags)
    least = re._parser.parse(source, flags).getwidth()[0]
    try:
        jvm = to_jvm(source, case_sensitive)
    except NeedsPython:
        jvm = None
    return Pattern(source, case_sensitive, jvm, least)


def to_jvm(source: str, case_sensitive: bool) -> str:
    out = ["(?Ud)" if case_sensitive else "(?iuUd)"]
    i, n, in_class, first = 0, len(source), False, False
    while i < n:
        c = source[i]
        if c == "\\":
            e = source[i + 1]
            i += 2
            if e in _SAME and not (in_class and e == "A"):
                out.append({"v": r"\x0B"}.get(e, "\\" + e))
            elif e in (_INSIDE if in_class else _OUTSIDE):
                out.append((_INSIDE if in_class else _OUTSIDE)[e])
            elif e == "x":
                out.append("\\x" + source[i : i + 2])
                i += 2
            elif e == "u":
                out.append("\\x{" + source[i : i + 4] + "}")
                i += 4
            elif e == "U":
                out.append("\\x{" + source[i : i + 8].lstrip("0") + "}")
                i += 8
            elif e in "123456789" and not in_class and not source[i : i + 1].isdigit():
                out.append("\\" + e)
            elif e.isalnum():
                raise NeedsPython(source)
            else:
                out.append("\\" + e)
            first = False
            continue
        if in_class:
            if c == "]" and not first:
                in_class = False
                out.append("]")
            elif c in "[]&~|" or c == "^" and not first:
                out.append("\\" + c)
            elif c == "-" and (first or source[i + 1 : i + 2] == "]"):
                out.append("\\-")
            else:
                out.append(c)
            first = False
        elif c == "[":
            in_class = first = True
            out.append("[")
            if source[i + 1 : i + 2] == "^":
                out.append("^")
                i += 1
        elif c == "(" and source[i + 1 : i + 2] == "?":
            m = re.match(r"\(\?P<([A-Za-z][A-Za-z0-9]*)>", source[i:])
            b = re.match(r"\(\?P=([A-Za-z][A-Za-z0-9]*)\)", source[i:])
            plain = re.match(r"\(\?(?:[:=!>]|<[=!])", source[i:])
            if m:
                out.append(f"(?<{m[1]}>")
                i += len(m[0])
            elif b:
                out.append(rf"\k<{b[1]}>")
                i += len(b[0])
            elif plain:
                out.append(plain[0])
                i += len(plain[0])
            elif re.match(r"\(\?[is]+\)", source[i:]) and i == 0:
                m = re.match(r"\(\?[is]+\)", source)
                out.append(m[0])
                i += len(m[0])
            else:  # conditionals, comments, verbose or ASCII mode, scoped flags, odd names
                raise NeedsPython(source)
            continue
        elif c == "{":
            m = re.match(r"\{(\d*)(,?)(\d*)\}", source[i:])
            if m and (m[1] or m[3]):
                out.append("{" + (m[1] or "0") + m[2] + m[3] + "}")
                i += len(m[0])
                continue
            out.append(r"\{")
        elif c == "}":
            out.append(r"\}")
        else:
            out.append(c)
        i += 1
    return "".join(out)


_LEADING = re.compile(r"((?:\(\?[a-z]+\))?)((?:\(\?<[=!](?:[^()\\]|\\.)*\))?)\^", re.S)


def let_quotes_lead(source: str, semantics: str = "documented") -> str:
    """Let quoted lines precede what a leading ``^`` anchors.

    Documented: a group that catches nothing, for either spelling of the quote mark, behind hoisted inline flags.
    Compat: as the original coded it, a catching group for ``>`` alone and no inline flags; ``^`` must have something behind it on one line.
    """
    m = _LEADING.match(source)
    if not m:
        return source
    flags, behind, rest = m[1], m[2], source[m.end() :]
    if semantics == "documented":
        return f"{flags}{behind}^(?:(?:&gt;|>).+\n\n)*{rest}"
    if flags:
        return source
    if not rest or "\n" in rest:
        raise ValueError("an anchored pattern needs one line behind its anchor")
    return f"{behind}^(>.+\n\n)*{rest}"
