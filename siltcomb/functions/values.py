"""Parameter values: months, shares, tokens with a part of speech."""

from __future__ import annotations

import os
import re

_MONTH = re.compile(r"(20[0-2]\d)-(\d{1,3})")


def month_of(text: str) -> tuple[int, int]:
    """``2019-2`` or ``2019-02`` as (2019, 2); ValueError for anything but a month of 2000 to 2029."""
    m = _MONTH.fullmatch(text.strip())
    if not m or (len(m[2]) == 3 and m[2][0] != "0") or not 1 <= int(m[2]) <= 12:
        raise ValueError(f"not a month (YYYY-MM): {text!r}")
    return int(m[1]), int(m[2])


def share_of(text: str) -> float:
    """A number from 0 to 1."""
    try:
        x = float(text)
    except ValueError:
        raise ValueError(f"not a number: {text!r}") from None
    if not 0 <= x <= 1:
        raise ValueError(f"not between 0 and 1: {text!r}")
    return x


def tagged_token(text: str) -> tuple[str, str]:
    """``token,TAG`` as a pair; further parts are ignored."""
    parts = text.split(",")
    if len(parts) < 2 or not parts[0] or not parts[1]:
        raise ValueError(f"not token,TAG: {text!r}")
    return parts[0], parts[1]


def folder_of(text: str) -> str:
    if not os.path.isdir(text):
        raise NotADirectoryError(text)
    return text


def pattern_of(text: str) -> str:
    """A regular expression, or the content of the file of that name."""
    if os.path.isfile(text):
        with open(text, encoding="utf-8") as f:
            return f.read()
    return text


def month_index(month: tuple[int, int]) -> int:
    return month[0] * 12 + month[1]


def within(name: str, first: tuple[int, int] | None, last: tuple[int, int] | None) -> bool:
    """Whether the month in a dump file's name lies between two months, both included; None leaves an end open."""
    m = re.search(r"(\d{4})-(\d{2})", name)
    if not m:
        return False
    at = month_index((int(m[1]), int(m[2])))
    return (first is None or at >= month_index(first)) and (last is None or at <= month_index(last))
