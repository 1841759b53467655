"""Words of whole texts, taken at the speed of bytes.translate and bytes.split.

A word is a run of digits, letters a-z (A-Z in lower case) and bytes of non-ASCII characters.
"""

from __future__ import annotations

_KEEP = {*range(48, 58), *range(97, 123), *range(128, 256)}
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b in _KEEP else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text; null has none."""
    return (text or "").encode().translate(_TABLE).split()
