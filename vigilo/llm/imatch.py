"""I-Match document fingerprints over randomised lexicon subsets.

The lexicon holds the terms (runs of letters, digits and non-ASCII characters, lower case) whose inverse
document frequency lies in a band: log(N / df) / log N from LOW to HIGH, so df from N ** (1 - HIGH) to
N ** (1 - LOW); counts are exact, over all documents. SUBSETS random lexicons are drawn by a hash of the
term. A lexicon is nested: its level-l part keeps a term with probability 2 ** -l. A text's distinct terms
that lie in the lexicon's part are sorted and hashed, one hash a lexicon at each of DEPTH neighbouring
levels; the text's number of distinct terms picks the first level, so that a hash covers a few terms
whatever the text's length, and an edit changes a share of the hashes only. The likeness of two
fingerprints is the share of equal hashes at the levels they have in common, lexicons that keep no term of
either left out.

A text none of whose terms are kept is fingerprinted by a hash of its whole text.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path, stage
from . import scan
from .common import id_and_text

LOW, HIGH = 0.15, 0.9
SUBSETS = 12
DEPTH = 3                    # neighbouring levels that a fingerprint holds
KEPT = 1                     # terms that a level's part keeps of a text: from KEPT to 2 * KEPT, in or out of the band
SENT_TERMS = 4_000_000       # lexicons of so many terms at most (8 bytes each) go to the tasks whole; larger ones are joined

_SALTS = scan.mix(np.arange(1, SUBSETS // 2 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LOW32 = np.uint64(0xFFFFFFFF)


# ------------------------------------------------------------------ terms, levels, hashes of a slice

def distinct_terms(part: scan.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term hash) of every text's distinct terms, sorted by text and hash, and their number for each text."""
    w = scan.words(scan.LOWER[part.buf], part.starts, scan.ALNUM)
    owner = w.owner()
    order = np.lexsort((w.h, owner))
    doc, h = owner[order], w.h[order]
    first = np.ones(len(h), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    doc, h = doc[first], h[first]
    return doc, h, np.bincount(doc, minlength=len(part))


def levels(n_terms: np.ndarray) -> np.ndarray:
    return np.maximum(np.log2(np.maximum(n_terms, 1) / KEPT).astype(np.int64), 1)


def _draws(h: np.ndarray):
    """For each lexicon the 32-bit draw of every term."""
    for salt in _SALTS:
        v = scan.mix(h ^ salt)
        yield v & _LOW32
        yield v >> np.uint64(32)


def _bars(level: np.ndarray) -> np.ndarray:
    return np.uint64(1 << 32) >> np.minimum(level, 32).astype(np.uint64)


def sampled(doc: np.ndarray, h: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Which of the terms lie in a lexicon's part at their text's level."""
    bar, out = _bars(level)[doc], np.zeros(len(h), bool)
    for draw in _draws(h):
        out |= draw < bar
    return out


def digests(doc: np.ndarray, h: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Hashes [text, level from its first on, lexicon] of sorted distinct terms; 0 where none is kept."""
    out = np.zeros((len(level), DEPTH, SUBSETS), np.uint32)
    bar = _bars(level)[doc]
    for r, draw in enumerate(_draws(h)):
        for deep in range(DEPTH):
            at = np.flatnonzero(draw < bar >> np.uint64(deep))
            if not len(at):
                continue
            d = doc[at]
            first = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
            place = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
            total = np.add.reduceat(scan.mix(h[at] ^ scan.mix(place.astype(np.uint64) + np.uint64(1))), first)
            out[d[first], deep, r] = (scan.mix(total) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    return out


def likeness(level_a, a, key_a, level_b, b, key_b) -> np.ndarray:
    """Share of equal hashes, row by row; without hashes to compare, whether the whole texts are equal."""
    score, n = np.zeros(len(level_a)), np.zeros(len(level_a), np.int64)
    for step in range(1 - DEPTH, DEPTH):
        at = np.flatnonzero(level_b - level_a == step)
        if not len(at):
            continue
        x, y = slice(max(step, 0), DEPTH + min(step, 0)), slice(max(-step, 0), DEPTH - max(step, 0))
        left, right = a[at, x].reshape(len(at), -1), b[at, y].reshape(len(at), -1)
        either = (left != 0) | (right != 0)
        n[at] = either.sum(1)
        score[at] = (either & (left == right)).sum(1) / np.maximum(n[at], 1)
    same = (key_a == key_b) & ~a.any((1, 2)) & ~b.any((1, 2))
    return np.where(n > 0, score, same.astype(float))


def spelled(level: np.ndarray, hashes: np.ndarray, key: np.ndarray) -> list[str]:
    """Fingerprints as text: the level and the hashes, or the whole text's hash, in hexadecimal digits."""
    some = hashes.any((1, 2))
    raw = hashes.astype(">u4").reshape(len(level), -1)
    return [f"{lv:02x}:{raw[i].tobytes().hex()}" if ok else f"text:{k:016x}"
            for i, (lv, ok, k) in enumerate(zip(level.tolist(), some.tolist(), key.tolist()))]


class Marks:
    """Levels, whole-text hashes and kept terms of a number of texts."""

    def __init__(self, texts: list[str], lexicon: np.ndarray | None):
        docs, terms, self.level, self.key, done = [], [], [], [], 0
        rows = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"])
        for part in scan.slices(iter([rows])):
            doc, h, n = distinct_terms(part)
            level = levels(n)
            keep = sampled(doc, h, level)
            doc, h = doc[keep], h[keep]
            if lexicon is not None and len(h):
                at = np.minimum(np.searchsorted(lexicon, h), max(len(lexicon) - 1, 0))
                keep = lexicon[at] == h if len(lexicon) else np.zeros(len(h), bool)
                doc, h = doc[keep], h[keep]
            docs.append(doc + done)
            terms.append(h)
            self.level.append(level)
            self.key.append(scan.span_hashes(part.buf, part.starts, part.ends))
            done += len(part)
        self.doc, self.h = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((docs, np.int64), (terms, np.uint64)))
        self.level, self.key = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((self.level, np.int64), (self.key, np.uint64)))

    def terms(self, rows: np.ndarray | slice = slice(None)) -> pa.ListArray:
        """The kept terms of the texts, or of a run of them, as lists."""
        start, stop, _ = rows.indices(len(self.level))
        first = np.searchsorted(self.doc, np.arange(start, stop + 1))
        return scan.lists(self.h[first[0]:first[-1]].view(np.int64), first - first[0], pa.int64())


# ------------------------------------------------------------------ the lexicon

def _term_counts(batches):
    for part in scan.slices(batches):
        _, h, _ = distinct_terms(part)
        h, n = np.unique(h, return_counts=True)
        yield scan.batch(_COUNTS, h.view(np.int64), n)


_COUNTS = pa.schema([("h", pa.int64()), ("n", pa.int64())])


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH, text_col: str = "text") -> DataFrame:
    """(h): hashes of the terms whose normalised inverse document frequency lies in the band, counted over all rows."""
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    n = texts.count()
    counts = texts.mapInArrow(_term_counts, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    least, most = n ** (1 - high), n ** (1 - low)
    return counts.where(F.col("n").between(F.lit(float(least)), F.lit(float(most)))).select("h")


def _fitted(docs: DataFrame, low: float, high: float, most: int):
    """The lexicon as a table, and as a sorted array sent to the tasks if it has `most` terms at most (else None)."""
    terms = stage(lexicon(docs, low, high), "lexicon")
    if terms.count() > most:
        return terms, None
    held = np.sort(np.asarray(terms.toArrow().column("h"), np.int64).view(np.uint64))
    return terms, docs.sparkSession.sparkContext.broadcast(held)


# ------------------------------------------------------------------ edited texts and what is compared

_MARKED = pa.schema([("uid", pa.int64()), ("kind", pa.int8()), ("pid", pa.int64()), ("doc_id", pa.int64()), ("n_chars", pa.int64()),
                     ("edited_sha256", pa.string()), ("whole", pa.binary()),
                     *((f"{p}{c}", t) for p in ("own_", "edited_", "next_")
                       for c, t in (("level", pa.int64()), ("key", pa.int64()), ("terms", pa.list_(pa.int64()))))])
_MARKED_DDL = ("uid long, kind byte, pid long, doc_id long, n_chars long, edited_sha256 string, whole binary, "
               + ", ".join(f"{p}_level long, {p}_key long, {p}_terms array<long>" for p in ("own", "edited", "next")))
_ROW, _HEAD, _TAIL = range(3)
SIDES = ("own", "edited", "next")


def _pack_texts(batches):
    for rows in batches:
        for lo in range(0, rows.num_rows, scan.SLICE_ROWS):
            part = rows.slice(lo, scan.SLICE_ROWS)
            packed = [zlib.compress((t or "").encode(), 1) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed, pa.binary()), part.column(2)], ["doc_id", "whole", "h"])


def _marked(uid: int, pid: int, ids: list, texts: list[str], follow: list[str], lex) -> pa.RecordBatch:
    """Rows of texts (one more than ids where the next texts are the list's own), with their edited texts."""
    n = len(ids)
    edited = [t[:len(t) - len(t) // 4] + nx[:len(t) // 4] for t, nx in zip(texts, follow)]
    shas = [hashlib.sha256(t.encode()).hexdigest() for t in edited]
    own, changed = Marks(texts, lex), Marks(edited, lex)
    columns = [own.level[:n], own.key[:n].view(np.int64), own.terms(slice(0, n)),
               changed.level, changed.key.view(np.int64), changed.terms(),
               own.level[1:], own.key[1:].view(np.int64), own.terms(slice(1, n + 1))]
    return scan.batch(_MARKED, np.arange(uid, uid + n), np.full(n, _ROW), np.full(n, pid), pa.array(ids, pa.int64()),
                      np.array([len(t) for t in texts[:n]], np.int64), pa.array(shas), pa.nulls(n, pa.binary()), *columns)


def _edge(kind: int, pid: int, doc_id, text: str) -> pa.RecordBatch:
    row = {"uid": [pid << 33], "kind": [kind], "pid": [pid], "doc_id": [doc_id], "n_chars": [len(text)], "whole": [zlib.compress(text.encode(), 1)]}
    return pa.RecordBatch.from_arrays([pa.array(row[f.name], f.type) if f.name in row else pa.nulls(1, f.type) for f in _MARKED], schema=_MARKED)


def _in_order(lex_sent):
    """Rows of a sorted partition, each with the row after it; the first and the last go out with their texts."""
    def run(batches):
        pid, uid, ids, texts, held, first = TaskContext.get().partitionId(), 1, [], [], 0, True
        lex = lex_sent.value if lex_sent is not None else None
        for rows in batches:
            for doc_id, packed in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                text = zlib.decompress(packed).decode()
                if first:
                    yield _edge(_HEAD, pid, doc_id, text)
                    first = False
                ids.append(doc_id)
                texts.append(text)
                held += len(text)
                if len(ids) > 1 and (held > scan.SLICE_BYTES or len(ids) > scan.SLICE_ROWS):
                    yield _marked((pid << 33) + uid, pid, ids[:-1], texts, texts[1:], lex)
                    uid, ids, texts, held = uid + len(ids) - 1, ids[-1:], texts[-1:], len(texts[-1])
        if len(ids) > 1:
            yield _marked((pid << 33) + uid, pid, ids[:-1], texts, texts[1:], lex)
        if ids:
            yield _edge(_TAIL, pid, ids[-1], texts[-1])
        scan.give_back()
    return run


def _in_order_compared(lex_sent):
    """The same, rows already hashed and compared: for lexicons that the tasks hold."""
    def run(batches):
        for rows in _in_order(lex_sent)(batches):
            at = dict(zip(rows.schema.names, rows.columns))
            if at["kind"][0].as_py() == _ROW:
                out = next(_compare(iter([rows])))
            else:
                out = pa.RecordBatch.from_arrays([at[f.name] if f.name in ("doc_id", "n_chars") else pa.nulls(len(rows), f.type)
                                                  for f in _OUT], schema=_OUT)
            yield pa.RecordBatch.from_arrays([at["kind"], at["pid"], at["whole"], *out.columns],
                                             ["kind", "pid", "whole", *out.schema.names])
    return run


def _over_edges(lex_sent):
    """A partition's last row with the next partition's first."""
    def run(batches):
        lex = lex_sent.value if lex_sent is not None else None
        for rows in batches:
            for pid, doc_id, own, after in zip(*(c.to_pylist() for c in rows.columns)):
                texts = [zlib.decompress(x).decode() for x in (own, after)]
                yield _marked(pid << 33, pid, [doc_id], texts, texts[1:], lex)
        scan.give_back()
    return run


_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                  ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
_OUT_DDL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _seen(part: pa.RecordBatch, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Level, hashes and whole-text hash of one of a row's texts."""
    level, key, terms = (part.column(part.schema.get_field_index(f"{side}_{c}")) for c in ("level", "key", "terms"))
    doc = np.repeat(np.arange(len(part)), terms.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    h = np.asarray(terms.flatten(), np.int64).view(np.uint64)
    order = np.lexsort((h, doc))
    level = np.asarray(level, np.int64)
    return level, digests(doc[order], h[order], level), np.asarray(key, np.int64).view(np.uint64)


def _sliced(batches):
    for rows in batches:
        for lo in range(0, rows.num_rows, scan.SLICE_ROWS):
            yield rows.slice(lo, scan.SLICE_ROWS)
    scan.give_back()


def _compare(batches):
    for part in _sliced(batches):
        own, edited, after = (_seen(part, side) for side in SIDES)
        c = [part.column(part.schema.get_field_index(name)) for name in ("doc_id", "n_chars", "edited_sha256")]
        yield scan.batch(_OUT, *c, spelled(*own), spelled(*edited), likeness(*own, *edited), likeness(*own, *after))


def _band_only(marked: DataFrame, terms: DataFrame, sides=SIDES) -> DataFrame:
    """Kept terms that are in the lexicon, by a join: for lexicons too large to send."""
    lists = [f"{side}_terms" for side in sides]
    held = (marked.select("uid", F.explode(F.array_distinct(F.concat(*lists))).alias("h")).join(terms, "h")
            .groupBy("uid").agg(F.collect_list("h").alias("band")))          # a text's sampled terms: a few for each lexicon
    band = F.coalesce("band", F.array().cast("array<long>"))
    return marked.join(held, "uid", "left").withColumns({x: F.array_intersect(x, band) for x in lists}).drop("band")


def edit_likeness(docs: DataFrame, low: float = LOW, high: float = HIGH, most_sent: int = SENT_TERMS, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row.

    The edited text is the text with its last quarter of characters replaced by as many first ones (or all)
    of the next document in the order of ids; after the last comes the first, a single row follows itself.
    Rows without an id come first; rows of one id are in the order of a hash of their text, each its own
    row. A null text is empty; empty texts are alike. An empty table gives no rows. Lexicons of more than
    most_sent terms are joined instead of sent to the tasks, with the same results.

    Texts are dealt by ranges of ids and sorted once, compressed. A partition sees every row's next row but
    its last one's; those few rows are matched with the next partition's first row in a job of their own.
    """
    docs = id_and_text(docs, id_col, text_col)
    spark = docs.sparkSession
    terms, lex = _fitted(docs, low, high, most_sent)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = docs.withColumn("h", F.xxhash64("text")).mapInArrow(_pack_texts, "doc_id long, whole binary, h long")
    ordered = packed.repartitionByRange(parts, "doc_id", "h").sortWithinPartitions("doc_id", "h", "whole")
    path = scratch_path(spark, "marked")
    (ordered.mapInArrow(_in_order_compared(lex), "kind byte, pid long, whole binary, " + _OUT_DDL) if lex is not None
     else ordered.mapInArrow(_in_order(lex), _MARKED_DDL)).write.option("compression", "zstd").parquet(path)
    marked = spark.read.parquet(path)
    heads, tails = (marked.where(F.col("kind") == k) for k in (_HEAD, _TAIL))
    order = Window.orderBy("pid")                          # one number a partition
    after = heads.select("pid", F.coalesce(F.lead("pid").over(order), F.min("pid").over(Window.partitionBy(F.lit(0)))).alias("next_pid"))
    met = (tails.select("pid", "doc_id", "whole").join(after, "pid")
           .join(heads.select(F.col("pid").alias("next_pid"), F.col("whole").alias("after")), "next_pid")
           .select("pid", "doc_id", "whole", "after"))
    last = met.mapInArrow(_over_edges(lex), _MARKED_DDL)
    rows = marked.where(F.col("kind") == _ROW)
    if lex is not None:
        return rows.select(*_OUT.names).union(last.mapInArrow(_compare, _OUT_DDL))
    return _band_only(rows.union(stage(last, "marked")), terms).select(*_MARKED.names).mapInArrow(_compare, _OUT_DDL)


def _own_marks(lex_sent):
    def run(batches):
        pid, uid = TaskContext.get().partitionId(), 0
        for part in scan.slices(batches):
            m = Marks(part.rows.column(1).to_pylist(), lex_sent.value if lex_sent is not None else None)
            yield scan.batch(_OWN, np.arange(uid, uid + len(part)) + (pid << 33), part.rows.column(0), m.level, m.key.view(np.int64), m.terms())
            uid += len(part)
    return run


_OWN = pa.schema([(c, _MARKED.field(c).type) for c in ("uid", "doc_id", "own_level", "own_key", "own_terms")])
_OWN_DDL = "uid long, doc_id long, own_level long, own_key long, own_terms array<long>"


def _spell(batches):
    for part in _sliced(batches):
        yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("doc_id")), pa.array(spelled(*_seen(part, "own")))],
                                         ["doc_id", "fingerprint"])


def fingerprints(docs: DataFrame, low: float = LOW, high: float = HIGH, most_sent: int = SENT_TERMS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint: one row per input row, whatever its id; a null text is empty. Equal texts have equal fingerprints."""
    docs = id_and_text(docs, id_col, text_col)
    terms, lex = _fitted(docs, low, high, most_sent)
    marked = docs.withColumn("text", F.coalesce("text", F.lit(""))).mapInArrow(_own_marks(lex), _OWN_DDL)
    if lex is None:
        marked = _band_only(stage(marked, "marked"), terms, ("own",))
    return marked.mapInArrow(_spell, "doc_id long, fingerprint string")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_likeness(spark.read.parquet(f"{sf_dir}/documents.parquet"))
