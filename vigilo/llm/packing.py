"""Best-fit packing of documents into fixed-length sequences by length patterns.

Documents become pieces of at most CAPACITY tokens; only longer documents are cut, and what does not
fill a sequence is the first piece. The pieces' lengths are counted (as many counts as there are token
positions), and on that histogram the packing is planned: patterns of one to three lengths that fill a
sequence exactly are enumerated, their repeat counts fitted to the histogram by non-negative least
squares (first to all, then to the SUPPORT patterns that count most), rounded largest first as far as
the histogram goes, and the remaining lengths packed best fit, a pattern as often as it goes each time,
which uses up a length each time. A plan has at most SUPPORT + CAPACITY patterns, however many documents
there are. Pieces are then numbered within their length, and a piece's number picks its
pattern, copy and place. Pieces carry their token ids all the way, as bytes until they have their places, so that the
rows of a sequence_id, by offset, are the packed sequence; checksums are taken from those ids.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from functools import lru_cache
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import stage
from . import scan
from .common import id_and_text
from .transducer import Kept, Splitter, byte_symbols, default_path, open_tokenizer

CAPACITY = 2048
END_ID = 0
ROUNDS = 120
SUPPORT = 4096            # patterns kept of a first fit to all, and fitted again
MAX_UNITS = 600_000       # distinct units remembered by a task; then it starts afresh, with the same results
ASKED = 4096              # pre-tokens whose tokens are objects of the library at a time
ROWS = 1024               # pieces handed on at a time
CHUNKS = 256              # numbering groups of a length; no group holds more than its share of it

_PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids", pa.binary()), ("chunk", pa.int32())])
_PIECE_DDL = "doc_id long, piece int, start long, length long, ids binary, chunk int"
_PACKED = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids", pa.list_(pa.int32())), ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
_PACKED_DDL = "doc_id long, piece int, start long, length long, ids array<int>, ids_crc32 long, sequence_id long, offset long"

#: A space is surely the first byte of a token if one of these bytes follows: visible ASCII but '<', with
#: which special strings begin, and leading bytes of characters that are never white space.
_CUTS = np.zeros(256, bool)
_CUTS[[*range(0x21, 0x7F), *(b for b in range(0xC3, 0xF5) if b not in (0xE1, 0xE2, 0xE3))]] = True
_CUTS[0x3C] = False


class IdStore:
    """Id sequences by the hash of their bytes; number 0 is the end of a document."""

    def __init__(self):
        self.kept, self.ids, self.n_ids, self.n = Kept(), np.zeros(1 << 16, np.uint32), 0, 0
        self.at, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.add(np.zeros(0, np.uint64), np.array([END_ID], np.uint32), np.array([1]))

    @staticmethod
    def _grown(a: np.ndarray, n: int) -> np.ndarray:
        return a if len(a) >= n else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])

    def add(self, h: np.ndarray, flat: np.ndarray, size: np.ndarray) -> None:
        n = self.n + len(size)
        self.ids = self._grown(self.ids, self.n_ids + len(flat))
        self.at, self.size = self._grown(self.at, n), self._grown(self.size, n)
        self.ids[self.n_ids: self.n_ids + len(flat)] = flat
        self.at[self.n: n] = self.n_ids + np.cumsum(size) - size
        self.size[self.n: n] = size
        self.kept.put(h, np.arange(self.n, n)[n - self.n - len(h):])
        self.n, self.n_ids = n, self.n_ids + len(flat)

    def spelled(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the numbered sequences one after another, and where each begins (and the end)."""
        size = self.size[numbers]
        total = np.append(0, np.cumsum(size))
        return self.ids[np.repeat(self.at[numbers] - total[:-1], size) + np.arange(total[-1])], total


def gathered(buf: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches buf[at:at + size] one after another, each with a place behind it, and these places."""
    ends = np.cumsum(size + 1) - 1
    return buf.take(np.repeat(at - (ends - size), size + 1) + np.arange(ends[-1] + 1), mode="clip"), ends


class UnitIds:
    """Ids of a slice's texts, from the library's model, asked once for each distinct pre-token.

    Texts are cut at sure token beginnings into units; a new unit is split into pre-tokens, and a new
    pre-token goes to the library. Both are kept by their hash.
    """

    def __init__(self, path: str):
        tokenizer, splitter = open_tokenizer(path)
        self.open(tokenizer, splitter, splitter.special)

    def open(self, tokenizer, splitter: Splitter, special: list[bytes]) -> None:
        """special: the splitter's strings that are one id each."""
        from tokenizers import Token

        self.tokenizer, self.splitter = tokenizer, splitter
        self.symbols = np.zeros(256, "<u2")
        for c, b in byte_symbols().items():
            self.symbols[b] = ord(c)
        self.special = {self.symbols[[*s]].tobytes().decode("utf-16-le"): [Token(tokenizer.token_to_id(s.decode()), s.decode(), (0, len(s)))]
                        for s in special}
        self.special_sizes = [len(s) for s in special]
        self.forget()

    def forget(self) -> None:
        self.units, self.tokens = IdStore(), IdStore()

    def _ids_of(self, buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens buf[begin:end] one after another, and how many each has."""
        tokenize, id_of, flat, size = self.tokenizer.model.tokenize, attrgetter("id"), [], []
        for i in range(0, len(begin), ASKED):
            raw, ends = gathered(buf, begin[i: i + ASKED], end[i: i + ASKED] - begin[i: i + ASKED])
            written = self.symbols[raw]
            written[ends] = 0x20                            # no byte is written as a space
            pieces = written.tobytes().decode("utf-16-le").split(" ")[:-1]
            found = [*map(tokenize, pieces)]
            for k in np.flatnonzero(np.isin(np.diff(ends, prepend=-1) - 1, self.special_sizes)).tolist():
                found[k] = self.special.get(pieces[k], found[k])
            n = np.fromiter(map(len, found), np.int64, len(found))
            flat.append(np.fromiter(map(id_of, chain.from_iterable(found)), np.uint32, int(n.sum())))
            size.append(n)
        return np.concatenate(flat), np.concatenate(size)

    def _learn(self, h: np.ndarray, text: np.ndarray, at: np.ndarray, size: np.ndarray) -> None:
        """Keep the ids of the new units text[at:at + size], whose hashes are h."""
        buf, ends = gathered(text, at, size)
        buf[ends] = 0x20
        part = scan.Slice(None, buf, ends - size, ends)
        begin = self.splitter.split(part)
        end = np.append(begin[1:], len(buf))
        closing = np.zeros(len(buf), bool)
        closing[ends] = True
        own = ~closing[begin]
        hashes = scan.span_hashes(buf, begin, end)
        got = self.tokens.kept.get(hashes)
        new = np.flatnonzero((got < 0) & own)
        if len(new):
            keys, first = np.unique(hashes[new], return_index=True)
            self.tokens.add(keys, *self._ids_of(buf, begin[new[first]], end[new[first]]))
            got[new] = self.tokens.kept.get(hashes[new])
        flat, total = self.tokens.spelled(got[own])
        total = total[np.searchsorted(begin[own], ends)]
        self.units.add(h, flat, np.diff(total, prepend=0))

    def of(self, part: scan.Slice) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the slice, each text's followed by END_ID, and where each text's begin (and the end)."""
        if self.units.n > MAX_UNITS:
            self.forget()
        buf = part.buf
        cut = np.zeros(len(buf) + 1, bool)
        if len(buf) > 1:
            cut[: len(buf) - 1] = (buf[:-1] == 0x20) & _CUTS[buf[1:]]
        cut[part.starts] = True
        cut[part.ends] = True
        begin = np.flatnonzero(cut[: len(buf)])
        end = np.append(begin[1:], len(buf))
        marks = np.zeros(len(buf), bool)
        marks[part.ends] = True
        closing = marks[begin]
        unit = np.zeros(len(begin), np.int64)
        own = np.flatnonzero(~closing)
        h = scan.span_hashes(buf, begin[own], end[own])
        got = self.units.kept.get(h)
        new = np.flatnonzero(got < 0)
        if len(new):
            keys, first = np.unique(h[new], return_index=True)
            at = own[new[first]]
            self._learn(keys, buf, begin[at], end[at] - begin[at])
            got[new] = self.units.kept.get(h[new])
        unit[own] = got
        ids, total = self.units.spelled(unit)
        return ids, np.append(0, total[np.flatnonzero(closing) + 1])


@lru_cache(maxsize=2)
def _unit_ids(path: str) -> UnitIds:
    return UnitIds(path)


@lru_cache(maxsize=2)
def _id_type(path: str) -> np.dtype:
    """How staged ids are written: two bytes each where the vocabulary allows it, highest first, so that bytes sort as the ids do."""
    return np.dtype(">u2" if max(open_tokenizer(path)[0].get_vocab(True).values()) < 1 << 16 else ">u4")


def _pieces(path: str, capacity: int):
    def run(batches):
        for part in scan.slices(batches):
            ids, first = _unit_ids(path).of(part)
            n = np.diff(first)
            head = np.where(n > capacity, n % capacity, n)
            many = np.where(n > capacity, n // capacity + (head > 0), 1)
            doc = np.repeat(np.arange(len(n)), many)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
            head = np.where(head > 0, head, capacity)[doc]
            start = np.where(piece > 0, head + (piece - 1) * capacity, 0)
            length = np.where(piece > 0, capacity, head)
            lo = first[doc] + start
            chunk = (scan.mix((start.astype(np.uint64) << np.uint64(32))
                              + scan.mix(doc.astype(np.uint64) + (np.uint64(len(ids)) << np.uint64(32)))) % np.uint64(CHUNKS)).astype(np.int32)
            for i in range(0, len(doc), ROWS):                                                    # pieces lie one after another
                j = min(i + ROWS, len(doc))
                end = int(lo[j - 1] + length[j - 1])
                written = ids[lo[i]: end].astype(_id_type(path))
                at = ((np.append(lo[i:j], end) - lo[i]) * written.itemsize).astype(np.int32)
                spelled = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(at), pa.py_buffer(written)])
                yield scan.batch(_PIECE, part.rows.column(0).take(pa.array(doc[i:j])), piece[i:j], start[i:j], length[i:j], spelled, chunk[i:j])
        _unit_ids(path).forget()
        scan.give_back()
    return run


def _with_checksums(batches):
    """The rows with their ids as numbers and the CRC-32 of these as little-endian 32-bit numbers."""
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            rows = batch.slice(i, ROWS)
            column = {name: rows.column(j) for j, name in enumerate(rows.schema.names)}
            written = column["ids"].cast(pa.large_binary())
            at = np.frombuffer(written.buffers()[1], np.int64)[written.offset: written.offset + len(written) + 1]
            n = np.append(0, np.cumsum(column["length"].to_numpy()))
            size = int(at[-1] - at[0]) // int(n[-1])
            ids = np.frombuffer(written.buffers()[2], np.uint8)[at[0]: at[-1]].view(f">u{size}").astype("<i4")
            raw, ends = memoryview(ids).cast("B"), (4 * n).tolist()
            crc = np.array([zlib.crc32(raw[a:b]) for a, b in zip(ends, ends[1:])], np.int64)
            column |= {"ids": scan.lists(ids, n, pa.int32()), "ids_crc32": pa.array(crc)}
            yield scan.batch(_PACKED, *(column[name] for name in _PACKED.names))


def exact_patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of one, two or three of the lengths, largest first, that fill the capacity exactly; 0 fills up."""
    have = np.zeros(capacity + 1, bool)
    have[lengths] = True
    out = [np.array([[capacity, 0, 0]])] if have[capacity] else []
    a = lengths[(2 * lengths >= capacity) & (lengths < capacity)]
    a = a[have[capacity - a]]
    out.append(np.stack([a, capacity - a, np.zeros_like(a)], 1))
    for x in lengths[(3 * lengths >= capacity) & (lengths < capacity - 1)]:
        b = lengths[(lengths <= x) & (2 * lengths >= capacity - x) & (lengths < capacity - x)]
        b = b[have[capacity - x - b]]
        out.append(np.stack([np.full_like(b, x), b, capacity - x - b], 1))
    return np.concatenate(out)


def fitted(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative x that brings the patterns' lengths near the counts, by multiplicative least-squares updates."""
    n = len(counts)

    def used(x):
        total = np.zeros(n)
        for k in range(patterns.shape[1]):
            total += np.bincount(patterns[:, k], x, n)
        total[0] = 0
        return total

    target = counts.astype(float)
    target[0] = 0
    want = target[patterns].sum(1)
    x = target[patterns].max(1) / np.maximum(np.bincount(patterns.ravel(), minlength=n)[patterns].max(1), 1)
    for _ in range(rounds):
        x *= want / np.maximum(used(x)[patterns].sum(1), 1e-9)
    return x


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a sequence, number of such sequences): every counted piece has its place once."""
    left = np.zeros(capacity + 1, np.int64)
    for length, c in counts.items():
        left[length] = c
    out: Counter = Counter()
    patterns = exact_patterns(np.flatnonzero(left), capacity) if left.any() else np.zeros((0, 3), int)
    if len(patterns):
        x = fitted(patterns, left, ROUNDS // 4)
        patterns = patterns[np.sort(np.argsort(-x, kind="stable")[:SUPPORT])]
        x = fitted(patterns, left)
        for i in np.argsort(-x, kind="stable"):
            need = Counter(int(v) for v in patterns[i] if v)
            times = min(int(x[i] + 0.5), *(int(left[v]) // m for v, m in need.items()))
            if times > 0:
                for v, m in need.items():
                    left[v] -= m * times
                out[tuple(sorted(need.elements(), reverse=True))] += times
    lengths = np.flatnonzero(left).tolist()
    while lengths:
        chosen, gap, top = Counter(), capacity, len(lengths)
        while top:
            top = bisect_right(lengths, gap, 0, top)
            while top and left[lengths[top - 1]] <= chosen[lengths[top - 1]]:
                top -= 1
            if not top:
                break
            v = lengths[top - 1]
            m = min(gap // v, int(left[v]) - chosen[v])
            chosen[v] += m
            gap -= m * v
        times = min(int(left[v]) // m for v, m in chosen.items())
        for v, m in chosen.items():
            left[v] -= m * times
        out[tuple(sorted(chosen.elements(), reverse=True))] += times
        lengths = [v for v in lengths if left[v]]
    return list(out.items())


def places(planned: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, end number, first sequence, pieces of the length in a sequence, offset of the first)."""
    cursor, base, rows = Counter(), 0, []
    for lengths, times in planned:
        offset = 0
        for v, m in Counter(lengths).items():
            rows.append((v, cursor[v], cursor[v] + m * times, base, m, offset))
            cursor[v] += m * times
            offset += m * v
        base += times
    return rows


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset.

    ids are the piece's token ids, those of the sequence from the offset on. A document is its library ids and then id 0; a null or empty text is that one id. Repeated rows and
    null ids are packed each; an empty table gives no rows. path: the tokenizer's file, there on every
    executor. The histogram and the plan, of bounded size, pass through the driver; pieces do not.
    """
    docs = id_and_text(docs, id_col, text_col)
    spark = docs.sparkSession
    pieces = stage(docs.mapInArrow(_pieces(path or default_path(), capacity), _PIECE_DDL), "pieces")
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = places(plan(counts, capacity))
    # a row for each length of each of SUPPORT + CAPACITY patterns at most, whatever the number of documents
    placed = F.broadcast(spark.createDataFrame(rows, "length long, lo long, hi long, base long, many long, first long"))

    groups = pieces.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("length", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("passed"))
    own = F.row_number().over(Window.partitionBy("length", "chunk").orderBy("doc_id", "piece", "ids"))
    numbered = pieces.withColumn("own", own).join(groups, ["length", "chunk"]).withColumn("number", F.col("own") - 1 + F.col("passed"))
    found = numbered.join(placed, (numbered.length == placed.length) & (F.col("number") >= F.col("lo")) & (F.col("number") < F.col("hi")))
    step = F.col("number") - F.col("lo")
    return found.select(
        "doc_id", "piece", "start", numbered.length, "ids",
        (F.col("base") + F.floor(step / F.col("many"))).cast("long").alias("sequence_id"),
        (F.col("first") + (step % F.col("many")) * numbered.length).alias("offset")).mapInArrow(_with_checksums, _PACKED_DDL)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces; their ids as a checksum."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("ids")
