"""MinHash near-duplicates by an inverted join over signature coordinates.

Method. A document's set is its distinct word shingles (52-bit fingerprints). Equal sets collapse to
one node, named by a 63-bit fingerprint of the set. A node's signature has POSTED + PROBED MinHash coordinates. Each representative is
posted under its (coordinate, value) pairs, ordered by how many documents carry a pair (rarest first):
two documents that agree in MATCH of the POSTED coordinates share a pair among the first
POSTED - MATCH + 1 of both, so only those pairs are posted, and pairs that one document alone carries
meet nobody. Posting lists are then merged in two passes:

1. every document of a list against the list's most central document (its hub), links confirmed on
   the full sets; components of these links;
2. lists that still hold several components: collisions counted between documents of different
   components, in blocks, a pair being skipped except in the first list that holds both. What passes
   the match threshold gives (document, component) pairs, and the document's full set is held against
   the full sets of all members of that component, block by block.

Documents of one component are never compared again, so a dense group of m near copies costs m
comparisons and not m * m; pairs inside a list are compared in memory and only those over the match
threshold leave the task, as (document, component). No list, component or pair is capped.

A pair at similarity exactly 0.8 is missed with probability P(Binomial(64, 0.8) < 38), 5e-5, or
P(Binomial(256, 0.8) < 178), 3e-5 for pass 2; links that are reported are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import id_and_text
from .graph import components
from . import scan

POSTED, MATCH = 64, 38
PROBED, MATCH_ALL = 192, 178
SIMILARITY = 80          # in hundredths
LIST_BLOCK, SET_BLOCK = 512, 128

_ELEMENT_BITS = np.uint64(12)
_FACTORS = scan.mix(np.arange(1, POSTED + PROBED + 1, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D)) | np.uint64(1)
_SALTS = scan.mix(np.arange(1, POSTED + PROBED + 1, dtype=np.uint64) * np.uint64(0x9E6C63D0876A9A35))

_SIGNED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("doc", pa.int64()), ("tokens", pa.list_(pa.int64()))])
_SIGNED_DDL = "doc_id long, n long, doc long, tokens array<long>"
_SETS = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("tokens", pa.list_(pa.int64())), ("signature", pa.binary()),
                   ("elements", pa.list_(pa.int64()))])
_SETS_DDL = "doc long, n long, tokens array<long>, signature binary, elements array<long>"


def _sets(part: scan.Slice, shingle: int):
    """Distinct elements of every text that has any, in order: texts, their bounds, elements."""
    w = scan.words(scan.LOWER[part.buf], part.starts, scan.NOT_SPACE)
    h, owner, _ = scan.gram_hashes(w, shingle)
    keyed = np.unique((owner.astype(np.uint64) << np.uint64(52)) | (h >> _ELEMENT_BITS))
    owner = (keyed >> np.uint64(52)).astype(np.int64)
    elements = keyed & np.uint64((1 << 52) - 1)
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    return owner[first], np.append(first, len(owner)), elements


def _fingerprints(elements: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 63-bit number for each set: equal sets, equal number."""
    if len(bounds) < 2:
        return np.zeros(0, np.int64)
    total = np.add.reduceat(scan.mix(elements ^ _SALTS[0]), bounds[:-1])
    return (scan.mix(total + np.diff(bounds).astype(np.uint64)) >> np.uint64(1)).view(np.int64)


def _signature(elements: np.ndarray, first: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Coordinates lo to hi of the signature of each set."""
    out = np.empty((len(first), hi - lo), np.uint64)
    if len(first):
        spread, held = scan.mix(elements + np.uint64(1)), np.empty_like(elements)
        for k in range(lo, hi):
            np.multiply(spread, _FACTORS[k], out=held)
            held += _SALTS[k]
            out[:, k - lo] = np.minimum.reduceat(held, first)
        out = scan.mix(out ^ _SALTS[lo:hi])
    return out


def _sign(shingle: int):
    def run(batches):
        for part in scan.slices(batches):
            who, bounds, elements = _sets(part, shingle)
            n = np.zeros(len(part), np.int64)
            n[who] = np.diff(bounds)
            doc = np.zeros(len(part), np.int64)
            doc[who] = _fingerprints(elements, bounds)
            sizes = np.zeros(len(part), np.int64)
            sizes[who] = POSTED
            tokens = scan.lists(_signature(elements, bounds[:-1], 0, POSTED).ravel().view(np.int64),
                                np.append(0, np.cumsum(sizes)), pa.int64())
            yield scan.batch(_SIGNED, part.rows.column(0), n, doc, tokens)
    return run


def _full(shingle: int):
    def run(batches):
        for part in scan.slices(batches):
            who, bounds, elements = _sets(part, shingle)
            if not len(who):
                continue
            sig = _signature(elements, bounds[:-1], 0, POSTED + PROBED)
            low = np.ascontiguousarray(sig[:, :POSTED]).astype(np.uint32).view(np.uint8).reshape(len(who), -1)
            packed = np.concatenate([low, sig[:, POSTED:].astype(np.uint8)], axis=1)
            yield scan.batch(
                _SETS, _fingerprints(elements, bounds), np.diff(bounds),
                scan.lists(sig[:, :POSTED].ravel().view(np.int64), np.arange(len(who) + 1) * POSTED, pa.int64()),
                pa.array([row.tobytes() for row in packed], pa.binary()),
                scan.lists(elements.view(np.int64), bounds, pa.int64()))
    return run


def _postings(reps: DataFrame) -> DataFrame:
    """doc, n, central, mask, coord, token: the prefix of each representative's coordinates, without lone ones."""
    tokens = reps.select("doc", "n", F.posexplode("tokens").alias("coord", "token"))
    # written first, as hubs, open lists and least ids below: only then can a hot token's rows be split over tasks
    freq = stage(tokens.groupBy("token").agg(F.count("*").alias("freq")).where("freq > 1"), "token-counts")
    per = (tokens.join(freq, "token").groupBy("doc", "n")
           .agg(F.sort_array(F.collect_list(F.struct("freq", "coord", "token"))).alias("s"))
           .select("doc", "n", F.size("s").alias("central"),
                   F.expr(f"slice(s, 1, greatest(0, {POSTED - MATCH + 1} - ({POSTED} - size(s))))").alias("s"))
           .withColumn("mask", F.expr("aggregate(s, 0L, (m, x) -> m | shiftleft(1L, x.coord))")))
    return per.select("doc", "n", "central", "mask", F.explode("s").alias("x")).select(
        "doc", "n", "central", "mask", "x.coord", "x.token")


def _collisions(key: tuple[pa.Scalar, ...], left: pa.Table) -> pa.Table:
    """Within a block pair of one posting list: (r, c), a document and another component it may link to."""
    lo, hi = key[1].as_py(), key[2].as_py()
    coord = left.column("coord")[0].as_py()
    width = 4 * POSTED + PROBED
    raw = np.frombuffer(b"".join(left.column("signature").to_pylist()), np.uint8).reshape(-1, width)
    low = np.ascontiguousarray(raw[:, :4 * POSTED]).view(np.uint32)
    rest = raw[:, 4 * POSTED:]
    col = {c: left.column(c).to_numpy() for c in ("doc", "n", "mask", "comp", "members", "block")}
    mask = ((col["mask"][:, None].view(np.uint64) >> np.arange(POSTED, dtype=np.uint64)) & np.uint64(1)).astype(bool)
    a, b = np.flatnonzero(col["block"] == lo), np.flatnonzero(col["block"] == hi)
    rs, cs = [], []
    for i in a:
        j = b[b > i] if lo == hi else b
        j = j[(col["comp"][j] != col["comp"][i])
              & (100 * np.minimum(col["n"][j], col["n"][i]) >= SIMILARITY * np.maximum(col["n"][j], col["n"][i]))]
        if not len(j):
            continue
        same = low[j] == low[i]
        hits = same.sum(1)
        keep = hits >= MATCH
        if keep.any():
            j, same, hits = j[keep], same[keep], hits[keep]
            keep = hits + (rest[j] == rest[i]).sum(1) >= MATCH_ALL
            # counted in the first list that holds both, skipped in the others
            keep &= np.argmax(same & mask[j] & mask[i], axis=1) == coord
            j = j[keep]
            mine = (col["members"][i], -col["comp"][i])
            for x in j:
                big, r = (i, x) if mine > (col["members"][x], -col["comp"][x]) else (x, i)
                rs.append(col["doc"][r])
                cs.append(col["comp"][big])
    pairs = np.unique(np.array([rs, cs], np.int64).T, axis=0) if rs else np.zeros((0, 2), np.int64)
    return pa.table({"r": pa.array(pairs[:, 0], pa.int64()), "c": pa.array(pairs[:, 1], pa.int64())})


def _confirm(key: tuple[pa.Scalar, ...], asked: pa.Table, members: pa.Table) -> pa.Table:
    """The first member of a component block that each asking document truly links to."""
    out_a, out_b = [], []
    if asked.num_rows and members.num_rows:
        held = [np.asarray(x.values) for x in members.column("elements")]
        size = np.array([len(x) for x in held])
        every, owner = np.concatenate(held), np.repeat(np.arange(len(held)), size)
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        ids = members.column("doc").to_numpy()
        for r, elements in zip(asked.column("r").to_numpy(), asked.column("elements")):
            mine = np.asarray(elements.values)
            lo, hi = np.searchsorted(every, mine, "left"), np.searchsorted(every, mine, "right")
            n = hi - lo
            at = np.repeat(lo - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
            both = np.bincount(owner[at], minlength=len(held))
            linked = np.flatnonzero(100 * both >= SIMILARITY * (size + len(mine) - both))
            if len(linked):
                out_a.append(r)
                out_b.append(ids[linked[0]])
    return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})


def _block(col: str, count, size: int):
    return F.pmod(F.xxhash64(col), F.ceil(count / F.lit(size)))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    component_id is the smallest id reachable over links (Jaccard of the full shingle sets at least
    0.8; A-Z lower-cased, words split at white space), kept says that it is the row's own id.
    Null and blank texts have empty sets, link with nothing and are kept. Rows that repeat an id are
    one document for the components; rows with a null id take part in nothing, have a null
    component_id and are kept. Ties go to the smaller id. An empty table gives no rows.
    """
    docs = id_and_text(docs, id_col, text_col)
    signed = stage(docs.mapInArrow(_sign(shingle), _SIGNED_DDL), "signed")
    usable = signed.where("n > 0 and doc_id is not null")
    nodes = stage(usable.groupBy("doc").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"),
                                            F.first("tokens").alias("tokens")), "nodes")
    post = stage(_postings(nodes), "postings")

    # full sets of the nodes that share a posting with another one, from one document each
    shared = post.join(post.groupBy("token").count().where("count > 1"), "token", "left_semi").select("doc").distinct()
    wanted = stage(nodes.select("doc", "doc_id").join(shared, "doc", "left_semi"), "wanted")
    sets = stage(docs.join(wanted.select("doc_id"), "doc_id", "left_semi").mapInArrow(_full(shingle), _SETS_DDL)
                 .join(wanted.select("doc"), "doc", "left_semi").dropDuplicates(["doc"]), "sets")

    # pass 1: against the hub of each list
    hubs = stage(post.groupBy("token").agg(F.max(F.struct("central", (-F.col("doc")).alias("minus")).alias("c")).alias("h"),
                                           F.count("*").alias("held")).where("held > 1").select("token", (-F.col("h.minus")).alias("hub")), "hubs")
    asked = (post.join(hubs, "token").where("doc <> hub").select("hub", "doc").distinct()
             .join(sets.select(F.col("doc").alias("hub"), F.col("n").alias("hn"), F.col("tokens").alias("ht")), "hub")
             .join(sets.select("doc", "n", "tokens"), "doc")
             .where(f"100 * least(n, hn) >= {SIMILARITY} * greatest(n, hn)")
             .where(F.size(F.array_intersect("ht", "tokens")) >= MATCH).select("hub", "doc"))
    # full sets go only to the pairs that match so far
    asked = stage(asked, "asked")
    overlap = F.size(F.array_intersect("he", "elements"))
    first = stage(
        asked.join(sets.select(F.col("doc").alias("hub"), F.col("n").alias("hn"), F.col("elements").alias("he")), "hub")
        .join(sets.select("doc", "n", "elements"), "doc")
        .where(100 * overlap >= SIMILARITY * (F.col("n") + F.col("hn") - overlap))
        .select(F.col("hub").alias("a"), F.col("doc").alias("b")), "links")
    comp = stage(components(first).select(F.col("node").alias("doc"), F.col("component").alias("comp")), "components")
    sizes = stage(comp.groupBy("comp").agg(F.count("*").alias("members")), "sizes")

    # pass 2: lists that still hold several components, hubs aside (they met everyone)
    rest = (post.join(hubs, "token").where("doc <> hub").join(comp, "doc", "left")
            .withColumn("comp", F.coalesce("comp", "doc")).select("doc", "n", "mask", "coord", "token", "comp"))
    rest = stage(rest, "rest")
    open_lists = stage(rest.groupBy("token").agg(F.count("*").alias("m"), F.min("comp").alias("c0"), F.max("comp").alias("c1")).where(
        "c0 <> c1").select("token", "m"), "open-lists")
    rest = (rest.join(open_lists, "token").join(sizes, "comp", "left").withColumn("members", F.coalesce("members", F.lit(1)))
            .join(sets.select("doc", "signature"), "doc")
            .withColumn("block", _block("doc", F.col("m"), LIST_BLOCK))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("m") / LIST_BLOCK) - 1)))
            .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).drop("other", "m"))
    found = stage(rest.groupBy("token", "lo", "hi").applyInArrow(_collisions, "r long, c long").distinct(), "found")
    member = comp.join(found.select(F.col("c").alias("comp")).distinct(), "comp", "left_semi").select(F.col("comp").alias("c"), "doc")
    lone = found.select("c").distinct().join(comp.select(F.col("comp").alias("c")), "c", "left_anti").select("c", F.col("c").alias("doc"))
    member = member.union(lone)
    blocks = (member.groupBy("c").agg(F.ceil(F.count("*") / SET_BLOCK).alias("mb")).join(
        found.groupBy("c").agg(F.ceil(F.count("*") / SET_BLOCK).alias("rb")), "c"))
    elements = sets.select("doc", "elements")
    rows = (found.join(blocks, "c").withColumn("i", F.pmod(F.xxhash64("r"), F.col("rb")))
            .withColumn("j", F.explode(F.expr("sequence(0L, mb - 1)")))
            .join(elements.withColumnRenamed("doc", "r"), "r").select("c", "i", "j", "r", "elements").toDF("c", "i", "j", "r", "elements"))
    held = (member.join(blocks, "c").withColumn("j", F.pmod(F.xxhash64("doc"), F.col("mb")))
            .withColumn("i", F.explode(F.expr("sequence(0L, rb - 1)")))
            .join(elements, "doc").select("c", "i", "j", "doc", "elements").toDF("c", "i", "j", "doc", "elements"))
    second = rows.groupBy("c", "i", "j").cogroup(held.groupBy("c", "i", "j")).applyInArrow(_confirm, "a long, b long")

    # from sets back to documents; a repeated id ties its sets together
    held_by = usable.select("doc_id", "doc").distinct()
    repeated = (held_by.groupBy("doc_id").agg(F.min("doc").alias("a"), F.max("doc").alias("z")).where("a <> z")
                .join(held_by, "doc_id").select("a", F.col("doc").alias("b")))
    links = comp.select(F.col("comp").alias("a"), F.col("doc").alias("b")).union(second).union(repeated)
    merged = stage(components(links), "components")
    of_node = stage(held_by.join(merged.withColumnRenamed("node", "doc"), "doc", "left").withColumn(
        "component", F.coalesce("component", "doc")).select("doc_id", "component"), "of-node")
    least = stage(of_node.groupBy("component").agg(F.min("doc_id").alias("component_id")), "least")
    by_id = of_node.join(least, "component").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    return (signed.select("doc_id", F.col("n").alias("n_shingles")).join(by_id, "doc_id", "left")
            .withColumn("component_id", F.coalesce("component_id", "doc_id"))
            .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5) -> DataFrame:
    """The rows of one document of each component, with all their columns.

    Repeated rows of the kept id fall to one of them; rows with a null id stay.
    """
    gone = near_duplicates(docs, id_col, text_col, shingle).where("not kept").select(F.col("doc_id").alias(id_col))
    rest = docs.join(gone.distinct(), id_col, "left_anti").select(docs.columns)
    repeated = stage(docs.groupBy(id_col).count().where(f"count > 1 and {id_col} is not null").select(id_col), "repeated")
    if not repeated.limit(1).count():
        return rest
    once = rest.join(repeated, id_col, "left_semi").dropDuplicates([id_col]).select(docs.columns)
    return rest.join(repeated, id_col, "left_anti").select(docs.columns).unionByName(once)


def op2(spark, sf_dir: str) -> DataFrame:
    """All documents at four words a shingle, by the query's contract."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=4)


ORACLE = r"""
with words as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') w
  from documents
), grams as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
         else list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) end g
  from words
), sized as (select doc_id, len(g) n, g from grams),
copies as (select min(doc_id) doc_id, any_value(n) n, list_sort(g) g from sized where n > 0 group by list_sort(g)),
flat as (select doc_id, unnest(g) s from copies),
pairs as (
  select a.doc_id a, b.doc_id b, count(*) both_n from flat a join flat b on a.s = b.s and a.doc_id < b.doc_id group by all
), links as (
  select a, b from pairs join copies x on x.doc_id = a join copies y on y.doc_id = b
  where 100 * both_n >= 80 * (x.n + y.n - both_n)
  union select c.doc_id, s.doc_id from sized s join copies c on list_sort(s.g) = c.g where s.n > 0 and s.doc_id <> c.doc_id
), edges as (select a, b from links union select b, a from links),
reach as (
  with recursive r(node, root) as (
    select doc_id, doc_id from sized
    union
    select e.b, r.root from r join edges e on e.a = r.node where r.root < e.b
  ) select node, min(root) root from r group by node
)
select s.doc_id, cast(s.n as bigint) n_shingles, r.root component_id, s.doc_id = r.root kept
from sized s join reach r on r.node = s.doc_id
"""
