"""Memoised work on the space-delimited pieces of texts, for byte-level pre-tokenizers.

The pre-tokenizer pattern attaches one space to the word behind it, so a single space between
two characters that are not white space always begins a new match, and no match looks past it.
A text may therefore be cut there and its pieces be handled apart; the results, concatenated,
are those of the whole text. Pieces recur, so each is worked out once and remembered.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterator

from siltcomb.llm._runtime import chunks_of

_CUT = re.compile(r"(?<=\S) (?=\S)")


class PieceTable:
    """Maps texts to the concatenated values of their pieces.

    ``work`` gets a list of strings and returns a value for each. At most ``limit`` pieces of up
    to ``longest`` characters are remembered; beyond it the table starts afresh, so memory stays bounded.
    """

    def __init__(self, work: Callable[[list[str]], list], limit: int = 500_000, longest: int = 64):
        self.work, self.limit, self.longest = work, limit, longest
        self.tail: dict = {}  # behind a space, with no other white space at either end; None where there is
        self.odd: dict = {}  # behind a space, from texts that need the careful cut
        self.head: dict = {}  # at the start of a text

    def _fill(self, table: dict, wanted: set, space: str, careful: bool) -> list[str]:
        missing = list(wanted.difference(table))
        todo = missing
        if not careful:
            unclear = [p for p in missing if not p or p[0].isspace() or p[-1].isspace()]
            table.update(dict.fromkeys(unclear))
            todo = [p for p in missing if p not in table] if unclear else missing
        if todo:
            table.update(zip(todo, self.work([space + p for p in todo]), strict=True))
        return [p for p in missing if len(p) > self.longest]

    def rows(self, texts: list[str], step: int = 3_000_000) -> Iterator[list]:
        """For each text, in order, the list of its pieces' values."""
        for a, b in chunks_of(texts, step):
            gc.disable()  # lists of strings by the hundred thousand and no cycles
            if len(self.tail) + len(self.odd) + len(self.head) > self.limit:
                for t in (self.odd, self.head):
                    t.clear()
                # what the next texts use is likely to be what most texts use
                used = set().union(*[t.split(" ") for t in texts[a:b]])
                self.tail = {p: self.tail[p] for p in used if p in self.tail} if len(used) < self.limit // 2 else {}
            cut = [t.split(" ") for t in texts[a:b]]
            first = [c.pop(0) for c in cut]
            heads, tails = set(first), set()
            for c in cut:
                tails.update(c)
            drop = [(self.tail, self._fill(self.tail, tails, " ", False))]
            get = self.tail.__getitem__
            found: list = []
            for i, (c, h) in enumerate(zip(cut, first, strict=True)):
                v = list(map(get, c))
                # a head that is empty or ends in white space leaves the first space in doubt
                bad = None in v or (c and (not h or h[-1].isspace()))
                found.append(None if bad else v)
                if bad:
                    first[i], *cut[i] = _CUT.split(texts[a + i])
                    heads.add(first[i])
            odd = [c for c, v in zip(cut, found, strict=True) if v is None]
            drop.append((self.odd, self._fill(self.odd, {p for c in odd for p in c}, " ", True)))
            drop.append((self.head, self._fill(self.head, heads, "", True)))
            gc.enable()
            for h, c, v in zip(first, cut, found, strict=True):
                yield [self.head[h], *(v if v is not None else map(self.odd.__getitem__, c))]
            for table, long in drop:
                for p in long:
                    table.pop(p, None)
