"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The n-grams of the test items are counted in the whole corpus; an item's seeds are its rarest ones
(SEED_SHARE of those that occur, with all ties), so that seeds stay few in texts that merely share common words,
an item whose copies are everywhere still has seeds, and a corpus several times over has the same ones. Places where a text holds a seed give
diagonals; near ones make a window, and the item is aligned with the window word by word, local and
with gaps. The score is the alignment's, as a share of that of an exact copy of the whole item. A text
leaks an item from a share of LEAK on, or where the alignment is worth RUN words in a row, however long
the item is; the rarest n-gram of every STRETCH words is a seed too, so that each such run holds one.

Items come to the tasks in blocks of ITEM_BLOCK, each with its own pass over the texts, so what a task
holds is bounded however many items there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import scan
from .common import id_and_text, ship

GRAM = 3
SEED_SHARE = 0.8
MATCH, MISMATCH, GAP = 2, -1, -1
LEAK = 0.5               # share of an exact copy's score from which a text counts as leaked
RUN = 30                 # words in a row whose score counts as leaked whatever share of the item they are
STRETCH = (RUN + 2 - GRAM) // 2          # the n-grams that begin in one such stretch lie whole in any run that begins up to it
PAD = 16                 # words aligned beyond the seeds' diagonals on either side
ITEM_BLOCK = 20_000
_CELLS = 1 << 19         # window words aligned at once; a wider window is aligned alone

_COUNT = pa.schema([("gram", pa.int64()), ("n", pa.int64())])
_LEAKS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("end_word", pa.int64())])
_LEAKS_DDL = "doc_id long, item_id long, score double, end_word long"


def _words(part: scan.Slice) -> scan.Words:
    return scan.words(scan.LOWER[part.buf], part.starts, scan.ALNUM)


def align(items: list[np.ndarray], windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of each item against its window, and the window place where it ends.

    Row by row over all pairs at once; the gaps along a row are a running maximum.
    """
    best, end = np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)
    order = np.argsort([len(w) for w in windows], kind="stable")
    width = np.array([len(w) for w in windows], np.int64)[order] + 1
    lo = 0
    while lo < len(order):
        # widths ascend: as many as fit, the widest being the last
        fits = width[lo:] * np.arange(1, len(order) - lo + 1) <= _CELLS
        hi = lo + max(1, int(fits.sum()))
        at, lo = order[lo:hi], hi
        rows, wide = max(len(items[i]) for i in at), max(len(windows[i]) for i in at)
        text, item = np.zeros((len(at), wide), np.uint64), np.zeros((len(at), rows), np.uint64)
        text_in, item_in = np.zeros((len(at), wide), bool), np.zeros((len(at), rows), bool)
        for k, i in enumerate(at):
            text[k, : len(windows[i])], text_in[k, : len(windows[i])] = windows[i], True
            item[k, : len(items[i])], item_in[k, : len(items[i])] = items[i], True
        slope = -GAP * np.arange(wide + 1)
        held = np.zeros((len(at), wide + 1), np.int64)
        for r in range(rows):
            same = (text == item[:, r: r + 1]) & text_in & item_in[:, r: r + 1]
            step = np.zeros_like(held)
            step[:, 1:] = np.maximum(held[:, :-1] + np.where(same, MATCH, MISMATCH), held[:, 1:] + GAP)
            held = np.maximum(np.maximum.accumulate(np.maximum(step, 0) + slope, axis=1) - slope, 0)
            top = held.argmax(1)
            score = held[np.arange(len(at)), top]
            better = score > best[at]
            best[at[better]], end[at[better]] = score[better], top[better] - 1
    return best, end


class Items:
    """Test items' words, their n-grams, and after the corpus count their seeds."""

    def __init__(self, ids: list[int], texts: list[str | None]):
        table = pa.record_batch({"id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string())})
        self.ids, self.words, grams, owner, place = [], [], [], [], []
        for part in scan.slices(iter([table])):
            w = _words(part)
            h, d, p = scan.gram_hashes(w, GRAM)
            full = w.counts()[d] >= GRAM
            grams.append(h[full])
            owner.append(d[full] + len(self.ids))
            place.append((p - w.first[d])[full])
            self.ids += part.rows.column(0).to_pylist()
            self.words += [w.h[a:b] for a, b in zip(w.first[:-1], w.first[1:])]
        self.grams = np.concatenate([*grams, np.zeros(0, np.uint64)])
        self.owner, self.place = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (owner, place))
        self.known = np.unique(self.grams)
        self.seeds = self.known

    def pick_seeds(self, counts: np.ndarray) -> None:
        """Keep of each item the n-grams whose corpus count is among its lowest."""
        n = counts[np.searchsorted(self.known, self.grams)]
        order = np.lexsort((n, self.owner))
        order = order[n[order] > 0]                    # what no text holds would seed nothing
        owner, n = self.owner[order], n[order]
        first = np.searchsorted(owner, np.arange(len(self.ids)))
        size = np.diff(np.append(first, len(owner)))
        last = first + np.maximum(np.ceil(SEED_SHARE * size).astype(int) - 1, 0)
        limit = n[np.minimum(last, len(n) - 1)] if len(n) else np.zeros(len(self.ids))
        few = n <= limit[owner] if len(n) else np.zeros(0, bool)
        _, stretch = np.unique(np.stack([owner, self.place[order] // STRETCH]), axis=1, return_inverse=True)
        least = np.full(len(order), np.iinfo(np.int64).max)
        np.minimum.at(least, stretch.ravel(), n)
        kept = order[few | (n == least[stretch.ravel()])]
        kept = kept[np.argsort(self.grams[kept], kind="stable")]
        self.grams, self.owner, self.place = self.grams[kept], self.owner[kept], self.place[kept]
        self.seeds = np.unique(self.grams)

    @staticmethod
    def _in(table: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Places of h whose value is in the sorted table."""
        if not len(table) or not len(h):
            return np.zeros(0, np.int64)
        return np.flatnonzero(table[np.minimum(np.searchsorted(table, h), len(table) - 1)] == h)

    def count_batches(self, batches):
        n = np.zeros(len(self.known), np.int64)
        for part in scan.slices(batches):
            h, _, _ = scan.gram_hashes(_words(part), GRAM)
            at = self._in(self.known, h)
            n += np.bincount(np.searchsorted(self.known, h[at]), minlength=len(n))
        seen = np.flatnonzero(n)
        yield scan.batch(_COUNT, seen, n[seen])

    def leaks(self, part: scan.Slice) -> Iterator[tuple[int, int, float, int]]:
        """(text, item, share, last word) of every window whose alignment reaches LEAK or is worth RUN words."""
        w = _words(part)
        h, d, p = scan.gram_hashes(w, GRAM)
        at = self._in(self.seeds, h)
        if not len(at):
            return
        lo, hi = np.searchsorted(self.grams, h[at], "left"), np.searchsorted(self.grams, h[at], "right")
        n = hi - lo
        seed = np.repeat(lo - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        text, word = np.repeat(d[at], n), np.repeat(p[at] - w.first[d[at]], n)
        item = self.owner[seed]
        diagonal = word - self.place[seed]
        order = np.lexsort((diagonal, item, text))
        text, item, diagonal = text[order], item[order], diagonal[order]
        length = np.array([len(x) for x in self.words])
        new = np.ones(len(order), bool)
        new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (np.diff(diagonal) > length[item[1:]])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(order)) - 1
        begin = np.maximum(diagonal[first] - PAD, 0)
        stop = np.minimum(diagonal[last] + length[item[first]] + PAD, w.counts()[text[first]])
        windows = [w.h[w.first[t] + a: w.first[t] + b] for t, a, b in zip(text[first], begin, stop)]
        score, end = align([self.words[i] for i in item[first]], windows)
        share = score / (MATCH * np.maximum(length[item[first]], 1))
        for k in np.flatnonzero((share >= LEAK) | (score >= MATCH * RUN)):
            yield int(text[first][k]), int(item[first][k]), float(share[k]), int(begin[k] + end[k])

    def leak_batches(self, batches):
        for part in scan.slices(batches):
            found = list(self.leaks(part))
            if found:
                yield scan.batch(_LEAKS, part.rows.column(0).take(pa.array([f[0] for f in found])), [self.ids[f[1]] for f in found],
                                 [f[2] for f in found], [f[3] for f in found])

    def clean_rows(self, text_col: str):
        """Rows of any columns whose text has no leak."""
        def run(batches):
            for part in scan.slices(batches, text_col):
                keep = np.ones(len(part), bool)
                for f in self.leaks(part):
                    keep[f[0]] = False
                yield part.rows.filter(pa.array(keep))
        return run


def item_blocks(docs: DataFrame, benchmark: DataFrame, item_col: str = "item_id", item_text: str = "text") -> Iterator[Items]:
    """Items in blocks, with their seeds picked by counts over all texts of docs (doc_id, text)."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")).where(
        "text is not null").distinct()
    blocks = max(1, -(-items.count() // ITEM_BLOCK))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        block = Items([r.item_id for r in rows], [r.text for r in rows])
        counts = np.zeros(len(block.known), np.int64)
        for r in docs.mapInArrow(block.count_batches, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
            counts[r.gram] = r.n
        block.pick_seeds(counts)
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per leaked (doc_id, item_id): score (share of an exact copy's) and the word where the best alignment ends.

    Scores are 0.5 to 1; of items of more than 2 x RUN words also less, where RUN words or more are copied.
    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. Null texts hold
    nothing, items of fewer than three words or without text match nothing; repeated ids give one row
    an item, with the highest score (ties: the earliest end); an empty table gives no rows.
    """
    docs = id_and_text(docs, id_col, text_col)
    found = docs.select("doc_id", F.lit(0).cast("long").alias("item_id"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("end_word")).where("false")
    for block in item_blocks(docs, benchmark):
        found = found.union(docs.mapInArrow(block.leak_batches, _LEAKS_DDL))
    best = F.max(F.struct("score", (-F.col("end_word")).alias("minus"))).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.score", (-F.col("best.minus")).alias("end_word"))


def drop_leaked(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows without any leak, with all their columns."""
    ship(docs.sparkSession)
    out = docs
    for block in item_blocks(id_and_text(docs, id_col, text_col), benchmark):
        out = out.mapInArrow(block.clean_rows(text_col), docs.schema)
    return out


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
