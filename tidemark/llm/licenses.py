"""Licence scan with a positional index of rare tokens.

Templates are fixed notices and licence texts; their words are licence words, and every position of every template is
posted. Of a file's licence words those with the highest inverse document frequency (over all documents scanned, then
over the templates) are looked up, as many as that file needs: verification lets some words of a template differ, and
words are looked up until those that are left could not make up a place that it accepts with fewer than VOTES votes. So
no such place is missed, and a file without enough licence words looks up none. Postings are intersected by relative
position: a word votes for (template, position in the file less position in the template). Places with enough votes are
verified: the share of template words that stand at their places reaches SCORE, and the template's mandatory key phrase
stands there, word for word. Base phrases are found wherever their words stand consecutively.

The score is the largest share of a verified place, or, where there is none, BASE_SCORE if there is a base phrase.

Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after A-Z are lower-cased. Null and empty texts have no words: counts
0, first_word and last_word null, labels '', score 0. Each row is scanned by itself, so repeated rows give equal
results. Only doc_id and text are read; other columns don't matter. A long text is one row of one batch; memory is a
few dozen bytes for each of its words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._text import ALNUM, Words, small_batches, spread, utf8

#: Fixed phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Fixed notices and licence texts: label, text, mandatory key phrase.
TEMPLATES = [
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", "affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    ("artistic-2.0", "this package is licensed under the artistic license 2 0", "artistic license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("bsl-1.0", "distributed under the boost software license version 1 0", "boost software license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "waived all copyright"),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", "eclipse public license"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", "lesser general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "permission is hereby granted free of charge"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
        "permission is hereby granted free of charge",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
        "with or without fee",
    ),
    (
        "bsd-2-clause",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
        "this software is provided by the copyright holders and contributors as is",
    ),
    (
        "bsd-3-clause",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution 3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "endorse or promote products derived from this software",
    ),
    (
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
        "apache license version 2 0",
    ),
    (
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
        "alter it and redistribute it freely",
    ),
    (
        "bsl-1.0",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
        "person or organization obtaining a copy",
    ),
    (
        "unlicense",
        "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
        "commercial or non commercial and by any means",
    ),
    (
        "gpl-notice",
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details",
        "gnu general public license for more details",
    ),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software"),
]
VOTES, SCORE, BASE_SCORE = 3, 0.7, 0.5


def _hashed(phrase: str) -> np.ndarray:
    return Words([phrase.encode()], ALNUM, lower=True).hashes()


def _vocabulary() -> np.ndarray:
    return np.unique(np.concatenate([_hashed(t[1]) for t in TEMPLATES]))


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[dict[int, int], int]:
    """In how many documents each template word is, and the number of documents. What comes back is bounded by the templates' words."""
    vocabulary = _vocabulary()

    def count(batches):
        df, n = np.zeros(len(vocabulary), np.int64), 0
        for batch in small_batches(batches):
            words = Words(utf8(batch.column(0)), ALNUM, lower=True)
            h = words.hashes()
            at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
            hit = np.flatnonzero(vocabulary[at] == h)
            doc = np.searchsorted(words.first, hit, "right") - 1
            pairs = np.unique(doc * len(vocabulary) + at[hit])
            df += np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
            n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.append(vocabulary.view(np.int64), 0)), pa.array(np.append(df, 0)), pa.array(np.append(np.zeros(len(df), np.int64), n))], ["h", "df", "n"])

    rows = docs.selectExpr(f"{text} AS text").mapInArrow(count, "h long, df long, n long").groupBy("h").sum("df", "n").collect()
    return {r[0]: r[1] for r in rows}, sum(r[2] for r in rows)


class Index:
    """Postings of all positions of the templates, by word; words have a rank, the rarest 0."""

    def __init__(self, df: dict[int, int], n: int):
        self.templates = [(label, _hashed(notice), _hashed(key)) for label, notice, key in TEMPLATES]
        vocabulary = _vocabulary()
        at = [np.searchsorted(vocabulary, words) for _, words, _ in self.templates]
        uses = np.stack([np.bincount(a, minlength=len(vocabulary)) for a in at], 1)  # of a word in a template
        seen = np.array([df.get(h, 0) for h in vocabulary.view(np.int64).tolist()])
        idf = np.log((n + 1) / (seen + 1)) + np.log((len(TEMPLATES) + 1) / (uses > 0).sum(1))
        by_rank = np.lexsort((vocabulary, -idf))
        rank = np.empty(len(vocabulary), np.int64)
        rank[by_rank] = np.arange(len(vocabulary))
        self.h, self.rank, self.uses = vocabulary, rank, uses[by_rank]
        self.least = np.array([next(c for c in range(len(words) + 1) if c / len(words) >= SCORE) for _, words, _ in self.templates])
        self.need = np.minimum(VOTES, self.least)
        ranks = np.concatenate([rank[a] for a in at])
        order = np.argsort(ranks, kind="stable")
        self.template = np.repeat(np.arange(len(at)), [len(a) for a in at])[order]
        self.place = np.concatenate([np.arange(len(a)) for a in at])[order]
        self.postings = np.searchsorted(ranks[order], np.arange(len(vocabulary) + 1))

    def looked_up(self, has: np.ndarray) -> np.ndarray:
        """For each file (row of has, which says which ranks it has) how many ranks are looked up: the words beyond must leave each template's acceptable places enough votes."""
        out = np.zeros(len(has), np.int64)
        some = np.flatnonzero((has @ self.uses >= self.least).any(1))
        for part in np.array_split(some, max(1, len(some) // 64)):
            after = np.cumsum((has[part][:, :, None] * self.uses)[:, ::-1], 1)[:, ::-1]  # positions of the words from a rank on
            short = (after > self.least - self.need).any(2)
            out[part] = np.where(short.any(1), short.shape[1] - short[:, ::-1].argmax(1), 0)
        return out

    def found(self, h: np.ndarray, doc: np.ndarray, first: np.ndarray):
        """(document, label, share of template words in place) of every verified place."""
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        hit = np.flatnonzero(self.h[at] == h)
        rank, d = self.rank[at[hit]], doc[hit]
        has = np.zeros((len(first) - 1, len(self.h)), np.int64)
        has[d, rank] = 1
        used = rank < self.looked_up(has)[d]
        hit, rank = hit[used], rank[used]
        n = self.postings[rank + 1] - self.postings[rank]
        post = spread(self.postings[rank], n)
        k, start = self.template[post], np.repeat(hit, n) - self.place[post]
        d = np.repeat(doc[hit], n)
        votes, counts = np.unique(np.stack([d, k, start], 1), axis=0, return_counts=True) if len(d) else (np.empty((0, 3), np.int64), np.empty(0, int))
        enough = counts >= self.need[votes[:, 1]]
        for d, k, start in votes[enough].tolist():
            label, words, key = self.templates[k]
            lo, hi = max(start, first[d]), min(start + len(words), first[d + 1])
            share = float((h[lo:hi] == words[lo - start : hi - start]).sum()) / len(words)
            if share < SCORE:
                continue
            span = h[max(first[d], lo - len(key)) : min(first[d + 1], hi + len(key))]
            if any((span[i : i + len(key)] == key).all() for i in np.flatnonzero(span[: max(0, len(span) - len(key) + 1)] == key[0])):
                yield d, label, share


def scanned(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    index = Index(*document_frequencies(docs, text))
    phrases = [(_hashed(p), label) for p, label in PHRASES.items()]

    def scan(batches):
        for batch in small_batches(batches):
            words = Words(utf8(batch.column(1)), ALNUM, lower=True)
            h, first, n = words.hashes(), words.first, batch.num_rows
            doc = words.of_word()
            base, least, most = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
            labels: list[set] = [set() for _ in range(n)]
            score = np.zeros(n)
            for phrase, label in phrases:
                at = np.flatnonzero(h[: max(0, len(h) - len(phrase) + 1)] == phrase[0])
                for k in range(1, len(phrase)):
                    at = at[h[at + k] == phrase[k]]
                at = at[doc[at] == doc[at + len(phrase) - 1]] if len(at) else at
                if not len(at):
                    continue
                base += np.bincount(doc[at], minlength=n)
                np.minimum.at(least, doc[at], at - first[doc[at]])
                np.maximum.at(most, doc[at], at - first[doc[at]])
                for d in np.unique(doc[at]):
                    labels[d].add(label)
            base_labels = [",".join(sorted(x)) for x in labels]
            for d, label, share in index.found(h, doc, first):
                labels[d].add(label)
                score[d] = max(score[d], share)
            score[(base > 0) & (score == 0)] = BASE_SCORE
            none = base == 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(first)),
                    pa.array(base),
                    pa.array(least, mask=none),
                    pa.array(most, mask=none),
                    pa.array(base_labels, pa.string()),
                    pa.array([",".join(sorted(x)) for x in labels], pa.string()),
                    pa.array(score),
                ],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    return docs.selectExpr(f"CAST({doc_id} AS long) AS doc_id", f"{text} AS text").mapInArrow(scan, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
