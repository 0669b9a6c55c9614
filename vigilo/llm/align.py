"""Alignment of two tokenizations of the same bytes, and corpus-wide counts of the linked id pairs.

A text is tokenized by a byte-level BPE (A, on a space and the text) and by a sentence-piece model (B,
which adds the space itself). Both spell the same bytes, so each gives an increasing array of end offsets,
and offsets at which tokens of both end cut the two into groups. `align` finds the groups by diagonal run
skipping: at the current index shift between the arrays it compares stretches of doubling length, halving
once they differ, and so jumps a run of one-to-one groups in a logarithmic number of comparisons; an
irregular group is walked through token by token to the next common end, which sets the new shift.

Two tokens are linked where their bytes overlap: between neighbouring ends, of either array, lies one link.
An id pair's count is the number of documents that hold it linked; counts cover all documents.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path, stage
from . import scan
from .common import id_and_text
from .packing import MAX_UNITS, IdStore, UnitIds
from .transducer import Splitter, byte_symbols, default_path, open_tokenizer

SENT_PAIRS = 6_000_000     # pair tables of so many rows at most (12 bytes each) go to the tasks whole; larger ones are joined
_B_IDS = 1 << 17           # a pair is a's id times this, plus b's


# ------------------------------------------------------------------ diagonal run skipping

def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the last A token and of the last B token of each group.

    ends_a, ends_b: strictly increasing 64-bit end offsets with the same last value (or both empty).
    """
    a, b = ends_a.astype(np.int64), ends_b.astype(np.int64)
    raw_a, raw_b = memoryview(a.tobytes()), memoryview(b.tobytes())
    list_a, list_b = a.tolist(), b.tolist()
    n, n_b, i, j = len(list_a), len(list_b), 0, 0
    runs: list[tuple[int, int, int]] = []              # one-to-one runs: first A token, first B token, number of groups
    while i < n:
        x, y = list_a[i], list_b[j]
        if x == y:
            begin, shift, step, growing = i, j - i, 1, True
            most = n if n + shift <= n_b else n_b - shift
            while step and i < most:
                stop = i + step
                if stop > most:
                    stop = most
                if raw_a[8 * i: 8 * stop] == raw_b[8 * (i + shift): 8 * (stop + shift)]:
                    step = step * 2 if growing else step // 2
                    i = stop
                else:
                    growing = False
                    step = (stop - i) // 2
            runs.append((begin, j, i - begin))
            j = i + shift
        else:                                          # an irregular group
            while x != y:
                if x < y:
                    i += 1
                    x = list_a[i]
                else:
                    j += 1
                    y = list_b[j]
            runs.append((i, j, 1))
            i += 1
            j += 1
    if not runs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first_a, first_b, size = np.fromiter(chain.from_iterable(runs), np.int64, 3 * len(runs)).reshape(-1, 3).T
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return np.repeat(first_a, size) + place, np.repeat(first_b, size) + place


# ------------------------------------------------------------------ the two tokenizers

class _PlainIds(UnitIds):
    """Ids of texts with strings of special tokens as plain text, without an id behind each text."""

    def __init__(self, path: str):
        tokenizer = open_tokenizer(path)[0]
        self.open(tokenizer, Splitter(tokenizer, []), [])


class _Spelling:
    """Bytes of every id of a vocabulary, laid out so that whole id arrays are spelled at once."""

    def __init__(self, entries: list[bytes]):
        self.size = np.array([len(x) for x in entries], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(entries), np.uint8)

    def of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, end offsets) of the ids one after another."""
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.bytes[np.repeat(self.at[ids] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)], ends


@lru_cache(maxsize=2)
def _open_a(path: str) -> tuple[_PlainIds, _Spelling]:
    ids = _PlainIds(path)
    stand_in = byte_symbols()
    entries = [b""] * ids.tokenizer.get_vocab_size(True)
    for token, i in ids.tokenizer.get_vocab(False).items():
        entries[i] = bytes(stand_in[c] for c in token) if all(c in stand_in for c in token) else token.encode()
    return ids, _Spelling(entries)


class _PieceIds:
    """Ids by a sentence-piece model, asked once for each distinct unit: a word with the spaces before it.

    No entry of the vocabulary holds a space behind another character, so nothing is merged across units.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in x.lstrip("▁") for x in pieces):
            raise ValueError(f"{path}: entries with a space behind another character are not aligned")
        self.spelling = _Spelling([bytes([int(x[3:5], 16)]) if self.model.is_byte(i) else x.replace("▁", " ").encode()
                                   for i, x in enumerate(pieces)])
        self.space = [self.model.piece_to_id("▁")]
        self.forget()

    def forget(self) -> None:
        self.units = IdStore()

    def of(self, part: scan.Slice) -> tuple[np.ndarray, np.ndarray]:
        """As UnitIds.of: ids of texts that begin with a space, an end id behind each text's, and where each text's begin."""
        if self.units.n > MAX_UNITS:
            self.forget()
        buf = part.buf
        cut = buf == 0x20
        cut[1:] &= buf[:-1] != 0x20
        cut[part.starts] = True
        cut[part.ends] = True
        begin = np.flatnonzero(cut)
        end = np.append(begin[1:], len(buf))
        marks = np.zeros(len(buf), bool)
        marks[part.ends] = True
        closing = marks[begin]
        unit, own = np.zeros(len(begin), np.int64), np.flatnonzero(~closing)
        h = scan.span_hashes(buf, begin[own], end[own])
        got = self.units.kept.get(h)
        new = np.flatnonzero(got < 0)
        if len(new):
            keys, first = np.unique(h[new], return_index=True)
            raw, at = buf.tobytes(), own[new[first]]
            found = self.model.encode([raw[a + 1:b].decode() for a, b in zip(begin[at].tolist(), end[at].tolist())], num_threads=1)
            found = [x or self.space for x in found]                       # a single space: the library adds none to an empty text
            size = np.array([len(x) for x in found], np.int64)
            self.units.add(keys, np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum())), size)
            got[new] = self.units.kept.get(h[new])
        unit[own] = got
        ids, total = self.units.spelled(unit)
        return ids, np.append(0, total[np.flatnonzero(closing) + 1])


@lru_cache(maxsize=2)
def _open_b(path: str) -> _PieceIds:
    return _PieceIds(path)


def piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


# ------------------------------------------------------------------ a slice of texts

@lru_cache(maxsize=2)
def _decimal(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 to n - 1, left aligned with a place for one more character, and their number."""
    i = np.arange(n)
    width = np.ones(n, np.int64)
    for k in range(1, 7):
        width += i >= 10 ** k
    out = np.zeros((n, 8), np.uint8)
    for k in range(7):
        power = width - 1 - k
        out[:, k] = np.where(power >= 0, i // 10 ** np.maximum(power, 0) % 10 + 48, 0)
    return out, width


def _without_ends(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and their number for each text, of ids with an end id behind each text's."""
    own = np.ones(len(ids), bool)
    own[first[1:] - 1] = False
    return ids[own].astype(np.int64), np.diff(first) - 1


class Aligned:
    """Tokens, groups and links of a slice's texts; arrays run over all texts, *_first says where each text begins."""

    def __init__(self, part: scan.Slice, path_a: str, path_b: str):
        n = len(part)
        (ids_a, spell_a), ids_b = _open_a(path_a), _open_b(path_b)
        spell_b = ids_b.spelling
        buf = np.insert(part.buf, part.starts, np.uint8(0x20))             # each text behind a space of its own
        begin = part.starts + np.arange(n)
        size = part.ends - part.starts + 1
        spaced = scan.Slice(None, buf, begin, begin + size)
        (a, n_a), (b, n_b) = (_without_ends(*ids.of(spaced)) for ids in (ids_a, ids_b))
        good = size > 1                                                    # not the empty text
        for ids, count, spell in ((a, n_a, spell_a), (b, n_b, spell_b)):
            spelled, _ = spell.of(ids)
            doc = np.repeat(np.arange(n), count)
            total = np.bincount(doc, spell.size[ids], n).astype(np.int64)
            good &= total == size
            stop = np.cumsum(total)
            for d in np.flatnonzero(good).tolist():
                good[d] = np.array_equal(spelled[stop[d] - size[d]: stop[d]], buf[begin[d]: begin[d] + size[d]])
        self.a, self.n_a = a[np.repeat(good, n_a)], np.where(good, n_a, 0)
        self.b, self.n_b = b[np.repeat(good, n_b)], np.where(good, n_b, 0)
        self.n = n
        ends_a, ends_b = spell_a.of(self.a)[1], spell_b.of(self.b)[1]
        self.last_a, self.last_b = align(ends_a, ends_b)                   # a text's end is an end of both: no group crosses texts
        self.doc_a, self.doc_b = np.repeat(np.arange(n), self.n_a), np.repeat(np.arange(n), self.n_b)
        self.n_groups = np.bincount(self.doc_a[self.last_a], minlength=n)
        # a link ends at each end of either: its A token is the one after all A ends before it, likewise B
        cuts = np.concatenate([ends_a, ends_b])
        order = np.argsort(cuts, kind="stable")
        last = np.append(np.diff(cuts[order]) > 0, True) if len(cuts) else np.zeros(0, bool)
        of_a, common = (order < len(ends_a))[last], np.diff(np.flatnonzero(last), prepend=-1) == 2
        self.link_a = np.cumsum(of_a | common) - (of_a | common)
        self.link_b = np.cumsum(~of_a | common) - (~of_a | common)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(text, id pair) of every link."""
        return self.doc_a[self.link_a], self.a[self.link_a] * _B_IDS + self.b[self.link_b]

    def spelled_groups(self) -> list[bytes]:
        """Each text's groups as a1,a2|b1;a3|b2,b3."""
        group_a = np.searchsorted(self.last_a, np.arange(len(self.a)))
        group_b = np.searchsorted(self.last_b, np.arange(len(self.b)))
        place_a = np.arange(len(self.a)) + np.append(0, self.last_b + 1)[group_a]      # behind the B tokens of earlier groups
        place_b = np.arange(len(self.b)) + (self.last_a + 1)[group_b]
        mark_a, mark_b = np.full(len(self.a), ord(","), np.uint8), np.full(len(self.b), ord(","), np.uint8)
        mark_a[self.last_a] = ord("|")
        mark_b[self.last_b] = ord(";")
        ids, marks = np.empty(len(self.a) + len(self.b), np.int64), np.empty(len(self.a) + len(self.b), np.uint8)
        ids[place_a], ids[place_b], marks[place_a], marks[place_b] = self.a, self.b, mark_a, mark_b
        digits, width = _decimal(_B_IDS)
        text, size = digits[ids], width[ids]
        text[np.arange(len(ids)), size] = marks
        flat = text[np.arange(8) <= size[:, None]].tobytes()
        token_end = np.append(0, np.cumsum(size + 1))
        end = token_end[np.cumsum(self.n_a + self.n_b)]
        return [flat[s: e - 1] if e > s else b"" for s, e in zip(np.append(0, end[:-1]).tolist(), end.tolist())]


# ------------------------------------------------------------------ Spark

_ALIGNED = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                      ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string()), ("pairs", pa.list_(pa.int64())),
                      ("times", pa.list_(pa.int32()))])
_ALIGNED_DDL = ("uid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, "
                "pairs array<long>, times array<int>")
_FEWER = 1 << 18          # bytes of a slice's texts here: tokens, ends and links of all its texts are held at once


def _small(part: scan.Slice):
    """A slice in runs of rows of _FEWER bytes at most (single rows may be longer)."""
    lo, n = 0, len(part)
    while lo < n:
        hi = max(int(np.searchsorted(part.ends, part.starts[lo] + _FEWER, "right")), lo + 1)
        at = part.starts[lo]
        yield scan.Slice(part.rows.slice(lo, hi - lo), part.buf[at: part.ends[hi - 1] + 1], part.starts[lo:hi] - at, part.ends[lo:hi] - at)
        lo = hi


def _aligned(path_a: str, path_b: str, with_groups: bool):
    def run(batches):
        uid = TaskContext.get().partitionId() << 33
        for whole in scan.slices(batches):
            for part in _small(whole):
                x = Aligned(part, path_a, path_b)
                doc, pair = x.links()
                order = np.lexsort((pair, doc))
                doc, pair = doc[order], pair[order]
                first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1]))) if len(doc) else np.zeros(0, np.int64)
                times = np.diff(np.append(first, len(doc)))
                offsets = np.searchsorted(doc[first], np.arange(x.n + 1))
                spelled = x.spelled_groups()
                shas = [hashlib.sha256(s).hexdigest() if s else "" for s in spelled]
                groups = pa.array([s.decode() for s in spelled]) if with_groups else pa.nulls(x.n, pa.string())
                yield scan.batch(_ALIGNED, np.arange(uid, uid + x.n), part.rows.column(0), x.n_a, x.n_b, x.n_groups,
                                 np.bincount(doc, minlength=x.n), pa.array(shas), groups,
                                 scan.lists(pair[first], offsets, pa.int64()), scan.lists(times, offsets, pa.int32()))
                uid += x.n
        _open_a(path_a)[0].forget()
        _open_b(path_b).forget()
        scan.give_back()
    return run


def alignments(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, with_groups: bool = True, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row per input row: uid, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, groups, pairs, times.

    groups: the aligned ids as `a1,a2|b1;a3|b2,b3` (null unless asked for); pairs: the distinct linked id
    pairs (see `pair_ids`), times: how often each is linked. Texts that are null or empty, or that one of the
    tokenizers doesn't spell byte for byte behind a space, have no tokens: zeros and empty values. uid is unique.
    path_a: a byte-level BPE file of the tokenizers library, path_b: a sentence-piece model; there on every executor.
    """
    docs = id_and_text(docs, id_col, text_col)
    return docs.mapInArrow(_aligned(path_a or default_path(), path_b or piece_path(), with_groups), _ALIGNED_DDL)


def pair_ids(pair) -> tuple:
    """Columns of A's and B's id of a pair."""
    pair = F.col(pair) if isinstance(pair, str) else pair
    return F.floor(pair / _B_IDS).cast("int"), (pair % _B_IDS).cast("int")


def _counted(batches):
    for rows in batches:
        pair, n = np.unique(np.asarray(rows.column(0).flatten(), np.int64), return_counts=True)
        yield scan.batch(_COUNTS, pair, n)


_COUNTS = pa.schema([("pair", pa.int64()), ("n", pa.int64())])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold the pair linked, and whether no pair of the same A id has more."""
    counts = aligned.select("pairs").mapInArrow(_counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = counts.withColumn("a", pair_ids("pair")[0])
    most = F.max("n").over(Window.partitionBy("a"))        # an A id has as many pairs as B has ids at most
    return counts.withColumn("best", F.col("n") == most).select("pair", "n", "best")


def _scored(sent):
    def run(batches):
        keys, n, best = sent.value
        for rows in batches:
            c = dict(zip(rows.schema.names, rows.columns))
            pair, times = (np.asarray(c[x].flatten(), np.int64) for x in ("pairs", "times"))
            doc = np.repeat(np.arange(len(rows)), c["pairs"].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            at = np.searchsorted(keys, pair)
            total = np.zeros((2, len(rows)), np.int64)
            np.add.at(total[0], doc, np.where(best[at], times, 0) if len(at) else times)
            np.add.at(total[1], doc, n[at] * times if len(at) else times)
            yield scan.batch(_SCORED, *(c[x] for x in _SCORED.names[:-2]), *total)
        scan.give_back()
    return run


_SCORED = pa.schema([*(_ALIGNED.field(x) for x in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")),
                     ("n_best", pa.int64()), ("count_sum", pa.int64())])
_SCORED_DDL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"


def linked_documents(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, most_sent: int = SENT_PAIRS,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the counts of `alignments`, n_best and count_sum.

    n_best: links whose pair's count is the highest of its A id (ties included); count_sum: the counts of all
    its links' pairs. Repeated rows are documents of their own; an empty table gives no rows. A pair table
    of more than most_sent rows is joined instead of sent to the tasks, with the same results.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "aligned")
    alignments(docs, path_a, path_b, False, id_col, text_col).drop("groups").write.option("compression", "zstd").parquet(path)
    aligned = spark.read.parquet(path)
    counts = stage(pair_counts(aligned), "pair-counts")
    if counts.count() <= most_sent:
        held = counts.orderBy("pair").toArrow()
        sent = spark.sparkContext.broadcast((np.asarray(held.column("pair"), np.int64), np.asarray(held.column("n"), np.int64),
                                             held.column("best").to_numpy(zero_copy_only=False).astype(bool)))
        return aligned.drop("uid").mapInArrow(_scored(sent), _SCORED_DDL)
    each = aligned.select("uid", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("uid", "x.pairs", "x.times")
    total = (each.join(counts, each.pairs == counts.pair).groupBy("uid")
             .agg(F.sum(F.when(F.col("best"), F.col("times").cast("long")).otherwise(F.lit(0).cast("long"))).alias("n_best"),
                  F.sum(F.col("times") * F.col("n")).alias("count_sum")))
    return (aligned.join(total, "uid", "left").withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_best", "count_sum")})
            .select(*_SCORED.names))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
