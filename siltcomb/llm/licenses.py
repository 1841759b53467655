"""License scans over a positional rare-token index of license templates.

Each template is a run of words with mandatory key phrases at known positions. How rare its words are
is counted over all documents. The index posts the ``POSTED`` rarest words of each template with their positions in it. A
file's licence words are looked up, rarest first; a posting tells where the template would begin, and where half of a
template's posted words agree on the beginning, give or take ``SLACK`` words, its postings intersect. There the key phrases are
compared word by word, each within the slack of its place. A template that keeps all its key phrases and at least ``LEAST`` of its
words (weighted by rarity) in their places labels the file; that share is its score. So a key phrase in other surroundings is no
label, and words that were put in or left out are no obstacle.

Base phrases label a file wherever they stand; each is found by its rarest word, and none can be missed.

Words: A-Z in lower case; digits, letters and non-ASCII characters. Null and empty texts have no words,
no labels ("") and score 0. Each row gets its own result, repeated rows the same; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltcomb.llm._runtime import narrowed, ship
from siltcomb.llm._words import words_of

#: Phrases that label a file wherever they stand.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

_MIT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software "
    "without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons "
    "to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the software the software is provided as is without warranty of any kind express or implied"
)
_BSD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code "
    "must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list "
    "of conditions and the following disclaimer in the documentation and or other materials provided with the distribution this software is provided by the copyright holders and contributors as is"
)
_ISC = (
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission "
    "notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software"
)
_APACHE = (
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at "
    "http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
    "without warranties or conditions of any kind either express or implied"
)
_GPL = (
    "this program is free software you can redistribute it and or modify it under the terms of the gnu {} public license as published by the free software foundation either version of the "
    "license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
    "merchantability or fitness for a particular purpose"
)

#: (label, words, key phrases among them). Openings, notices that the licenses prescribe or that are in common use, and whole short licenses.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge", "associated documentation files")),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", ("apache license version 2 0",)),
    ("gpl", "licensed under the gnu general public license", ("gnu general public license",)),
    ("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    ("agpl", "licensed under the gnu affero general public license", ("gnu affero general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "following conditions are met")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify and or distribute", "without fee is hereby granted")),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial", ("creative commons attribution noncommercial",)),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike", ("creative commons attribution sharealike",)),
    ("cc-by-sa", "this work is licensed under cc by sa", ("cc by sa",)),
    ("cc-by-nd", "this work is licensed under cc by nd", ("cc by nd",)),
    ("cc0", "to the extent possible under law the author has waived all copyright", ("has waived all copyright",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software", "public domain")),
    # a full name and a version will do
    ("gpl", "gnu general public license version", ("gnu general public license",)),
    ("lgpl", "gnu lesser general public license version", ("gnu lesser general public license",)),
    ("agpl", "gnu affero general public license version", ("gnu affero general public license",)),
    ("mit", _MIT, ("permission is hereby granted free of charge", "substantial portions of the software", "the software is provided as is")),
    ("bsd", _BSD, ("redistribution and use in source and binary forms", "redistributions in binary form must reproduce", "this software is provided by the copyright holders")),
    ("isc", _ISC, ("permission to use copy modify and or distribute", "the software is provided as is and the author disclaims")),
    ("apache-2", _APACHE, ("apache license version 2 0", "distributed on an as is basis")),
    ("gpl", _GPL.format("general"), ("under the terms of the gnu general public license", "without even the implied warranty")),
    ("lgpl", _GPL.format("lesser general"), ("under the terms of the gnu lesser general public license", "without even the implied warranty")),
    ("agpl", _GPL.format("affero general"), ("under the terms of the gnu affero general public license", "without even the implied warranty")),
)


#: Words that are posted of a template, words that a place may be off, and the least share of a template that labels a file.
POSTED, SLACK, LEAST = 12, 3, 0.6


class Index:
    """Templates by their rarest words, base phrases by their single rarest."""

    def __init__(self, base, templates, seen: dict[bytes, int], n_docs: int):
        idf = lambda w: math.log((n_docs + 1) / (seen.get(w, 0) + 1)) + 1
        #: word -> [(phrase, label, position of the word in it)]
        self.base: dict[bytes, list] = defaultdict(list)
        for phrase, label in base:
            words = words_of(phrase)
            i = max(range(len(words)), key=lambda i: (idf(words[i]), -i))
            self.base[words[i]].append((words, label, i))
        self.templates = []
        #: word -> [(template, position of the word in it)]
        self.postings: dict[bytes, list] = defaultdict(list)
        for label, text, keys in templates:
            words, phrases = words_of(text), [words_of(k) for k in keys]
            at = [next(i for i in range(len(words)) if words[i : i + len(p)] == p) for p in phrases]
            rare = sorted(range(len(words)), key=lambda i: (-idf(words[i]), i))[:POSTED]
            for j in rare:
                self.postings[words[j]].append((len(self.templates), j))
            self.templates.append((label, words, list(zip(at, phrases, strict=True)), [idf(w) for w in words], (len(rare) + 1) // 2))
        self.rarity = {w: idf(w) for w in [*self.postings, *self.base]}

    def _begins(self, hits: list[tuple[int, int]], least: int) -> list[int]:
        """Where a template may begin: ``least`` of its posted words agree within the slack."""
        hits.sort()
        out, first, held = [], 0, Counter()
        for begin, j in hits:
            held[j] += 1
            while begin - hits[first][0] > 2 * SLACK:
                old = hits[first][1]
                held[old] -= 1
                if not held[old]:
                    del held[old]
                first += 1
            if len(held) >= least:
                middle = (hits[first][0] + begin) // 2
                if not out or middle > out[-1]:
                    out.append(middle)
        return out

    def _share(self, words: list[bytes], template: int, begin: int) -> float:
        """The share of the template that stands there; 0 if a key phrase is missing."""
        _, whole, keys, weights, _ = self.templates[template]
        for at, phrase in keys:
            places = range(max(0, begin + at - 2 * SLACK), begin + at + 2 * SLACK + 1)
            if not any(words[p : p + len(phrase)] == phrase for p in places):
                return 0.0
        same = sum(x for j, (w, x) in enumerate(zip(whole, weights, strict=True)) if w in words[max(0, begin + j - 2 * SLACK) : max(0, begin + j + 2 * SLACK + 1)])
        return min(1.0, same / sum(weights))

    def scan(self, text: str | None) -> tuple:
        words = words_of(text)
        rarity = self.rarity
        found = defaultdict(list)
        for i, w in enumerate(words):
            if w in rarity:
                found[w].append(i)
        hits: dict[int, list] = defaultdict(list)
        places: list[int] = []
        base_labels, labels, score = set(), set(), 0.0
        for w in sorted(found, key=lambda w: -rarity[w]):
            for phrase, label, offset in self.base.get(w, ()):
                for i in found[w]:
                    if i >= offset and words[i - offset : i - offset + len(phrase)] == phrase:
                        places.append(i - offset)
                        base_labels.add(label)
                        score = 1.0
            for template, j in self.postings.get(w, ()):
                hits[template] += [(i - j, j) for i in found[w]]
        for template, some in hits.items():
            label, _, _, _, least = self.templates[template]
            if len({j for _, j in some}) >= least:
                share = max((self._share(words, template, b) for b in self._begins(some, least)), default=0.0)
                if share >= LEAST:
                    labels.add(label)
                    score = max(score, share)
        join = lambda s: ",".join(sorted(s))
        return len(words), len(places), min(places, default=None), max(places, default=None), join(base_labels), join(base_labels | labels), score


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", base=BASE, templates=TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every document."""
    ship(df.sparkSession)
    t = narrowed(df, doc_id=id_col, text=text_col)
    vocab = sorted({w for phrase, _ in base for w in words_of(phrase)} | {w for _, text, _ in templates for w in words_of(text)})

    def count(batches):
        known, seen, n = set(vocab), Counter(), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                n += 1
                seen.update(known.intersection(words_of(text)))
        yield pa.RecordBatch.from_arrays([pa.array([b"", *seen], pa.binary()), pa.array([n, *seen.values()], pa.int64())], ["word", "n"])

    counted = t.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    seen = {bytes(r["word"]): r["n"] for r in counted.collect()}  # one row for each template word at most
    n_docs = seen.pop(b"", 0)

    def run(batches):
        index = Index(base, templates, seen, n_docs)
        for batch in batches:
            rows = [index.scan(x) for x in batch.column(1).to_pylist()]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]], names)

    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kind = t.schema["doc_id"].dataType.simpleString()
    return t.mapInArrow(run, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
