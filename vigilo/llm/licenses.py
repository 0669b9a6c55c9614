"""License scan: phrase places, and an exact set-similarity join of text blocks with license templates.

For a template of n words texts are cut into blocks of 2 n words, one every n / 2, so that any passage of
3 n / 2 words lies within one. A block matches a template if it holds at least CONTAINMENT of the
template's distinct words. All words are ordered by their frequency in the whole corpus, rarest first. A
template that needs o of its t words must share one of its t - o + 1 rarest with a matching block (prefix
filter, an index from those words to their templates), the block must have o distinct words (length
filter), and the places of the first shared word in both orders bound what can still be shared
(positional filter); what passes is counted exactly. Only template words need counting, so the order is a
small table. A matching block is labelled if the words also stand in the template's order: as many of
them, as a longest common subsequence.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import scan
from .common import id_and_text

#: Phrases of the contract: words and label.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Texts of public licenses and notices: words and label.
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files to deal in the software without restriction", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the "
     "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
     "persons to whom the software is furnished to do so subject to the following conditions the above copyright "
     "notice and this permission notice shall be included in all copies or substantial portions of the software the "
     "software is provided as is without warranty of any kind express or implied including but not limited to the "
     "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors "
     "or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or "
     "otherwise arising from out of or in connection with the software or the use or other dealings in the software", "mit"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
     "provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("licensed under the apache license you may not use this file except in compliance with the license you may "
     "obtain a copy of the license at", "apache-2"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an "
     "as is basis without warranties or conditions of any kind either express or implied see the license for the specific "
     "language governing permissions and limitations under the license", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation", "gpl-3"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", "bsd"),
    ("redistributions of source code must retain the above copyright notice this list of conditions and the following "
     "disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
     "following disclaimer in the documentation and or other materials provided with the distribution", "bsd"),
    ("all rights reserved", "all-rights-reserved"),
)

CONTAINMENT = 0.9

_COUNT = pa.schema([("word", pa.int32()), ("n", pa.int64())])
_FOUND = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())])
_SPANS = pa.schema([("doc_id", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("template", pa.int32()),
                    ("label", pa.string()), ("score", pa.float64())])
_SPANS_DDL = "doc_id long, first_word long, last_word long, template int, label string, score double"
_FOUND_DDL = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


class Templates:
    """Templates as sets of word numbers; numbers follow the words' hashes."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES, containment: float = CONTAINMENT):
        words = [(scan.literal_hashes(text.lower(), scan.ALNUM), label) for text, label in templates]
        words = [(h, label) for h, label in words if len(h)]
        self.vocabulary = np.unique(np.concatenate([*(h for h, _ in words), np.zeros(0, np.uint64)]))
        self.texts = [np.searchsorted(self.vocabulary, h) for h, _ in words]
        self.sets = [np.unique(x) for x in self.texts]
        self.labels = [label for _, label in words]
        self.sizes = np.array([len(x) for x in self.texts], np.int64)
        self.in_order = [math.ceil(containment * n - 1e-9) for n in self.sizes]
        self.need = [math.ceil(containment * len(s) - 1e-9) for s in self.sets]
        self.phrases = [(scan.literal_hashes(text, scan.ALNUM), label) for text, label in phrases]
        self.order_by(np.zeros(len(self.vocabulary), np.int64))

    def order_by(self, counts: np.ndarray) -> None:
        """Rank the words by corpus count, rarest first, ties by number."""
        order = np.lexsort((np.arange(len(counts)), counts))
        self.rank = np.empty(len(counts), np.int64)
        self.rank[order] = np.arange(len(counts))
        self.sets = [s[np.argsort(self.rank[s])] for s in self.sets]
        prefixes = [s[: len(s) - need + 1] for s, need in zip(self.sets, self.need)]
        word = np.concatenate([*prefixes, np.zeros(0, np.int64)]).astype(np.int64)
        template = np.repeat(np.arange(len(prefixes)), np.array([len(x) for x in prefixes], np.int64))
        by_word = np.argsort(word, kind="stable")
        self.index_word, self.index_template = word[by_word], template[by_word]

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Number of each word, -1 outside the vocabulary."""
        if not len(self.vocabulary):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == h, at, -1)

    def phrase_places(self, w: scan.Words) -> list[tuple[np.ndarray, str]]:
        """For each phrase the word places where it begins, within one text."""
        out = []
        for h, label in self.phrases:
            anchor = len(h) - 1
            at = np.flatnonzero(w.h == h[anchor]) - anchor
            at = at[at >= 0]
            for j in range(anchor):
                at = at[w.h[at + j] == h[j]]
            text = np.searchsorted(w.first, at, "right")
            out.append((at[np.searchsorted(w.first, at + anchor, "right") == text], label))
        return out

    def candidates(self, w: scan.Words, number: np.ndarray) -> np.ndarray:
        """Distinct rows (text, template, block) of the blocks that hold a word of the template's prefix."""
        lo, hi = np.searchsorted(self.index_word, number, "left"), np.searchsorted(self.index_word, number, "right")
        at = np.flatnonzero(hi > lo)
        n = (hi - lo)[at]
        template = self.index_template[np.repeat(lo[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        at = np.repeat(at, n)
        text = np.searchsorted(w.first, at, "right") - 1
        size = self.sizes[template]
        stride = np.maximum(size // 2, 1)
        last = -(-np.maximum(w.counts()[text] - 2 * size, 0) // stride)          # number of a text's last block
        place = at - w.first[text]
        found = [np.zeros((0, 3), np.int64)]
        for back in range(int((-(-2 * size // stride)).max(initial=0))):
            block = place // stride - back
            ok = (block >= 0) & (block <= last) & (place < block * stride + 2 * size)
            found.append(np.unique(np.stack([text, template, block], 1)[ok], axis=0))
        return np.unique(np.concatenate(found), axis=0)

    def block_matches(self, w: scan.Words, number: np.ndarray):
        """(text, template, containment, first word, words) of every matching block."""
        for i, t, b in self.candidates(w, number).tolist():
            words, need, size = self.sets[t], self.need[t], int(self.sizes[t])
            lo = w.first[i] + b * max(size // 2, 1)
            hi = min(lo + 2 * size, w.first[i + 1])
            if hi - lo < need:
                continue
            held = np.unique(number[lo:hi])
            held = held[held >= 0]
            held = held[np.argsort(self.rank[held])]
            prefix = words[: len(words) - need + 1]
            place = int(np.flatnonzero(np.isin(prefix, held))[0])
            other = int(np.flatnonzero(held == prefix[place])[0])
            if 1 + min(len(words) - place - 1, len(held) - other - 1) < need:
                continue
            shared = len(np.intersect1d(words, held, assume_unique=True))
            if shared >= need:
                yield i, t, shared / len(words), int(lo - w.first[i]), int(hi - lo)

    def labelled(self, w: scan.Words, number: np.ndarray):
        """(text, template, containment, first word, last word) of the matching blocks in the template's order.

        The words are those of a longest common subsequence: first and last are its ends.
        """
        for i, t, share, lo, size in self.block_matches(w, number):
            block = number[w.first[i] + lo: w.first[i] + lo + size]
            template = self.texts[t]
            # best[j]: longest subsequence that ends within the first j words of the block; begin[j]: where it begins, latest
            best, begin = np.zeros(size + 1, np.int64), np.full(size + 1, -1)
            for word in template:
                hit = np.flatnonzero(block == word)
                if not len(hit):
                    continue
                grown, start = best.copy(), begin.copy()
                for j in hit.tolist():
                    n, s = best[j] + 1, begin[j] if best[j] else j
                    if (n, s) > (grown[j + 1], start[j + 1]):
                        worse = j + 1 + np.flatnonzero((grown[j + 1:] < n) | ((grown[j + 1:] == n) & (start[j + 1:] < s)))
                        grown[worse], start[worse] = n, s
                best, begin = grown, start
            if best[size] >= self.in_order[t]:
                stop = int(np.searchsorted(best, best[size], "left"))
                yield i, t, share, lo + int(begin[stop]), lo + stop - 1


def _words(part: scan.Slice) -> scan.Words:
    return scan.words(scan.LOWER[part.buf], part.starts, scan.ALNUM)


def _count(templates: Templates):
    def run(batches):
        n = np.zeros(len(templates.vocabulary), np.int64)
        for part in scan.slices(batches):
            number = templates.numbers(_words(part).h)
            n += np.bincount(number[number >= 0], minlength=len(n))
        yield scan.batch(_COUNT, np.arange(len(n)), n)
    return run


def _scan(templates: Templates):
    def run(batches):
        for part in scan.slices(batches):
            w = _words(part)
            n = len(part)
            base, all_labels = [set() for _ in range(n)], [set() for _ in range(n)]
            n_base, score = np.zeros(n, np.int64), np.zeros(n)
            first, last = np.full(n, -1), np.full(n, -1)
            for at, label in templates.phrase_places(w):
                text = np.searchsorted(w.first, at, "right") - 1
                for i, p in zip(text.tolist(), (at - w.first[text]).tolist()):
                    base[i].add(label)
                    n_base[i] += 1
                    first[i] = p if first[i] < 0 else min(first[i], p)
                    last[i] = max(last[i], p)
                    score[i] = 1.0
            for i, t, share, _, _ in templates.labelled(w, templates.numbers(w.h)):
                all_labels[i].add(templates.labels[t])
                score[i] = max(score[i], share)
            none = pa.array(first < 0)
            null = pa.scalar(None, pa.int64())
            yield scan.batch(
                _FOUND, part.rows.column(0), w.counts(), n_base,
                pc.if_else(none, null, pa.array(first, pa.int64())), pc.if_else(none, null, pa.array(last, pa.int64())),
                [",".join(sorted(x)) for x in base], [",".join(sorted(x | y)) for x, y in zip(base, all_labels)], score)
    return run


def _spans(templates: Templates):
    def run(batches):
        for part in scan.slices(batches):
            w = _words(part)
            # of the overlapping blocks that hold the same passage, one row
            found = sorted({(i, lo, hi, t): s for i, t, s, lo, hi in templates.labelled(w, templates.numbers(w.h))}.items())
            if found:
                at, score = zip(*found)
                text, first, last, t = zip(*at)
                yield scan.batch(_SPANS, part.rows.column(0).take(pa.array(text)), first, last, t, [templates.labels[k] for k in t], score)
    return run


def _ordered(docs: DataFrame, templates, phrases, containment: float) -> Templates:
    """Templates with their words in the order of the corpus counts."""
    known = Templates(templates, phrases, containment)
    counts = np.zeros(len(known.vocabulary), np.int64)
    for r in docs.mapInArrow(_count(known), "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():
        counts[r.word] = r.n                                        # a row for each template word
    known.order_by(counts)
    return known


def license_spans(docs: DataFrame, templates=TEMPLATES, containment: float = CONTAINMENT,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per passage that follows a template: doc_id, first_word, last_word, template (its number), label, score.

    Words are counted from 0; score is the containment of the block that holds the passage. Null and empty texts
    hold none; repeated rows and null ids are scanned each; templates without words are left out.
    """
    docs = id_and_text(docs, id_col, text_col)
    return docs.mapInArrow(_spans(_ordered(docs, templates, (), containment)), _SPANS_DDL)


def scan_licenses(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, containment: float = CONTAINMENT,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts all places of the phrases, first_word and last_word are the smallest and largest start
    (null without any), base_labels their labels, labels those and the templates' (sorted, comma-joined);
    score is 1 with a phrase, else the highest containment found, else 0. A null text is empty and has
    empty labels; repeated rows and null ids are scanned each; an empty table gives no rows.
    """
    docs = id_and_text(docs, id_col, text_col)
    known = _ordered(docs, templates, phrases, containment)
    return docs.mapInArrow(_scan(known), _FOUND_DDL)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
