"""Exact token counts of every prefix of a text, by dynamic programming over its bytes.

The encoding of a prefix ends in exactly one token, and what stands before that token is the
encoding of a shorter prefix. So, going through a pre-token byte by byte, the last token of each
prefix is the one vocabulary entry ending there that BPE would leave beside the last token of the
prefix before it; its count is that prefix's count plus one. Whether two tokens may stand side by
side is found by undoing their merges from the boundary outwards, latest merge first: if a merge
across the boundary would have come earlier than the merges still standing, they may not.

The counts of all prefixes are kept (as differences, one for each code point). Cutting a text to a
budget, or asking what a prefix costs, then takes a look-up and no encoding.

Texts: null counts as empty, with no tokens. Special strings inside texts are what the library
takes them for by default. Repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from functools import lru_cache
from operator import sub

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siltcomb.llm._pieces import PieceTable
from siltcomb.llm._runtime import narrowed, ship
from siltcomb.llm.token_files import byte_alphabet, cuttable

#: The usual byte-level pattern, as the byte-level pre-tokenizer of the tokenizers library has it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class PrefixTable:
    """The token counts of all prefixes of one text, read from what :func:`prefix_tables` stored."""

    def __init__(self, data: bytes):
        self.counts = np.cumsum(np.frombuffer(zlib.decompress(data), "<i4"))

    def tokens(self, n_chars: int) -> int:
        """Tokens of the first ``n_chars`` code points."""
        return int(self.counts[n_chars - 1]) if n_chars else 0

    def longest(self, budget: int) -> int:
        """Code points of the longest prefix of at most ``budget`` tokens."""
        return longest(self.counts, budget)


def longest(counts: np.ndarray, budget: int) -> int:
    if not len(counts) or counts[-1] <= budget:
        return len(counts)
    fit = np.flatnonzero(counts <= budget)  # counts may fall again: a longer prefix can have fewer tokens
    return int(fit[-1]) + 1 if len(fit) else 0


class PrefixCounter:
    """Prefix counts for a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        if not cuttable(path):
            raise ValueError(f"no byte-level BPE file that this operator can take apart: {path}")
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = byte_alphabet()
        raw = lambda s: bytes(byte_of[c] for c in s)
        special = {a["content"] for a in spec.get("added_tokens") or []}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        made = {a + b for a, b in merges}  # an added token may be one that a merge makes too
        vocab = {k: v for k, v in spec["model"]["vocab"].items() if k not in special or k in made or (len(k) == 1 and k in byte_of)}
        self.id_of = {raw(k): v for k, v in vocab.items()}
        # tokens are renumbered by the merge that makes them, bytes first
        order = {self.id_of[bytes([b])]: b for b in range(256)}
        self.pair: dict[int, int] = {}
        self.parts = {b: (b, b) for b in range(256)}
        for a, b in merges:
            whole = vocab[a + b]
            if whole not in order:
                order[whole] = len(order)
                left, right = order[vocab[a]], order[vocab[b]]
                self.pair[left << 32 | right] = order[whole]
                self.parts[order[whole]] = (left, right)
        #: each token made by one merge, parts before wholes: then the recurrence is exact
        self.in_order = len(order) == len(vocab) == 256 + len(merges)
        self.token_of = {k: order[v] for k, v in self.id_of.items() if v in order}
        self.longest_token = max(map(len, self.token_of))
        self.split = regex.compile(PATTERN).findall
        self.blank = regex.compile(r"\s+").fullmatch
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        #: whether a special string may begin another: then its beginnings are not all plain text
        self.nested = any(a != b and a in b for a in special for b in special)
        self.fits: dict[int, bool] = {}
        #: differences of the prefix counts of pre-tokens
        self.known: dict[str, bytes] = {}
        self.table = PieceTable(self._work)

    def _beside(self, a: int, b: int) -> bool:
        """Whether BPE leaves tokens ``a`` and ``b`` side by side."""
        pair, parts, bound = self.pair, self.parts, 1 << 62
        while True:
            joined = pair.get(a << 32 | b)
            if joined is not None and joined < bound:
                return False
            if a > b and a > 255 or b <= 255 < a:
                bound, a = a, parts[a][1]
            elif b > 255:
                bound, b = b + 1, parts[b][0]  # at equal rank the left one merged first
            else:
                return True

    def _extend(self, data: bytes, last: list[int], count: list[int]) -> None:
        """Go on from the prefix that ``last`` and ``count`` cover to the end of ``data``."""
        token_of, fits, most = self.token_of, self.fits, self.longest_token
        for i in range(len(count), len(data) + 1):
            for j in range(max(0, i - most), i):
                t = token_of.get(data[j:i])
                if t is None:
                    continue
                if j:
                    key = last[j] << 32 | t
                    ok = fits.get(key)
                    if ok is None:
                        if len(fits) > 400_000:
                            fits.clear()
                        ok = fits[key] = self._beside(last[j], t)
                    if not ok:
                        continue
                last.append(t)
                count.append(count[j] + 1)
                break

    def learn(self, words: set[str]) -> None:
        """Work out pre-tokens. In sorted order, each goes on from what it shares with the one before."""
        known = self.known
        done, last, count = b"", [-1], [0]
        for data, word in sorted([(w.encode(), w) for w in words]):
            k, most = 0, min(len(done), len(data))
            while k < most and done[k] == data[k]:
                k += 1
            del last[k + 1 :], count[k + 1 :]
            self._extend(data, last, count)
            done = data
            if len(data) == len(word):
                counts = count[1:]
            else:
                counts, at = [], 0
                for c in word:
                    at += 1 if c < "\x80" else 2 if c < "\u0800" else 3 if c < "\U00010000" else 4
                    counts.append(count[at])
            if word[0] == "'" and 1 < len(word) <= 3:  # a contraction cut short is a mark and letters
                counts = [sum(self._whole(p) for p in self.split(word[:k])) for k in range(1, len(word))] + counts[-1:]
            known[word] = array("i", map(sub, counts, [0, *counts[:-1]])).tobytes()

    def _whole(self, word: str) -> int:
        count = [0]
        self._extend(word.encode(), [-1], count)
        return count[-1]

    def _word(self, word: str) -> list[int]:
        """Counts of the prefixes of a pre-token, by its code points."""
        found = self.known.get(word)
        if found is None:
            self.learn({word})
            found = self.known[word]
            if len(word) > 64:
                del self.known[word]
        return np.cumsum(np.frombuffer(found, "<i4")).tolist()

    def ordinary(self, text: str) -> list[int]:
        """Counts of the prefixes of a text without special strings."""
        out: list[int] = []
        base = before = 0
        previous = ""
        for word in self.split(text):
            counts = self._word(word)
            at = len(out)
            out += [base + c for c in counts]
            if previous and self.blank(word[0]) and self.blank(previous):
                # without what follows, the white space would be one pre-token
                out[at] = before + self._word(previous + word[0])[-1]
            before, base, previous = base, base + counts[-1], word
        return out

    def counts(self, text: str) -> list[int]:
        """Tokens of each prefix of ``text``, by code points."""
        if self.special is None or not self.special.search(text):
            return self.ordinary(text)
        out: list[int] = []
        base = at = 0
        for m in self.special.finditer(text):
            plain = self.ordinary(text[at : m.start()])
            if self.nested:
                cut = [self.counts(text[at:k])[-1] for k in range(at + 1, m.end())]
            else:
                cut = self.ordinary(text[at : m.end()])[:-1]  # up to its last character a special string is plain text
            out += [base + c for c in cut]
            base += (plain[-1] if plain else 0) + 1
            out.append(base)
            at = m.end()
        return out + [base + c for c in self.ordinary(text[at:])]

    def _work(self, chunks: list[str]) -> list[bytes]:
        split, special, known = self.split, self.special, self.known
        if len(known) > 400_000:
            known.clear()
        # an ASCII word is one pre-token, a mark behind it another
        cut = [split(c) if not (c.isascii() and (c[:1] == " " or c[:1].isalpha())) else [c] if c[1:].isalpha() else [c[:-1], c[-1]] if c[1:-1].isalpha() and c[-1] in ".,;:?!" else split(c) for c in chunks]
        missing = {w for c in cut for w in c if w not in known}
        self.learn(missing)
        blank = self.blank
        if special and not special.search("\n".join(chunks)):
            special = None
        out = []
        for chunk, c in zip(chunks, cut, strict=True):
            if not (special and special.search(chunk)) and (len(c) < 3 and not (c and blank(c[0])) or not any(map(blank, c))):
                out.append(b"".join([known[w] for w in c]))
            else:
                counts = self.counts(chunk)
                out.append(np.diff(np.array([0, *counts], "<i4")).tobytes())
        if not self.in_order:  # the file's merges aren't in the usual order: ask the library
            for i, (chunk, e) in enumerate(zip(chunks, self.tok.encode_batch_fast(chunks, add_special_tokens=False), strict=True)):
                if int(np.frombuffer(out[i], "<i4").sum()) != len(e):
                    counts = [len(self.tok.encode(chunk[:k], add_special_tokens=False)) for k in range(1, len(chunk) + 1)]
                    out[i] = np.diff(np.array([0, *counts], "<i4")).tobytes()
        for w in missing:
            if len(w) > 64:
                known.pop(w, None)
        return out

    def tables(self, texts: list[str]):
        """For each text, the differences between the counts of its prefixes."""
        for values in self.table.rows(texts):
            yield np.frombuffer(b"".join(values), "<i4")


@lru_cache(maxsize=4)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def prefix_tables(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, table): ``table`` is read by :class:`PrefixTable`."""

    def run(batches):
        c = counter(path)
        for batch in batches:
            found = list(c.tables([t or "" for t in batch.column(1).to_pylist()]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([int(x.sum()) for x in found], pa.int64()), pa.array([zlib.compress(x.tobytes(), 1) for x in found], pa.binary())], ["doc_id", "n_tokens", "table"])

    ship(df.sparkSession)
    t = narrowed(df, doc_id=id_col, text=text_col)
    return t.mapInArrow(run, f"doc_id {t.schema['doc_id'].dataType.simpleString()}, n_tokens long, table binary")


def budgets(df: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fit_chars): ``fit_chars`` is the longest prefix within ``limit`` tokens."""

    def run(batches):
        c = counter(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n, fit = [], []
            for x in c.tables(texts):
                counts = np.cumsum(x)
                n.append(int(counts[-1]) if len(counts) else 0)
                fit.append(longest(counts, limit))
            size = [len(t) if t.isascii() else len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_()), pa.array(fit, pa.int64())], ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    ship(df.sparkSession)
    t = narrowed(df, doc_id=id_col, text=text_col)
    return t.mapInArrow(run, f"doc_id {t.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")


def library_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens) for any vocabulary file: .json by tokenizers, .model by sentencepiece; whole texts only."""

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".model"):
            import sentencepiece

            one = sentencepiece.SentencePieceProcessor(model_file=path)
            count = lambda t: len(one.encode(t))
        else:
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(path)
            tok.no_truncation()
            tok.no_padding()
            count = lambda t: len(tok.encode(t, add_special_tokens=False))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([count(t or "") for t in batch.column(1).to_pylist()], pa.int64())], ["doc_id", "n_tokens"])

    ship(df.sparkSession)
    t = narrowed(df, doc_id=id_col, text=text_col)
    return t.mapInArrow(run, f"doc_id {t.schema['doc_id'].dataType.simpleString()}, n_tokens long")
