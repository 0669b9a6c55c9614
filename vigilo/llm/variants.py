"""Grouping of spelling variants: words one edit apart, found with bit-sliced position indexes.

Words are counted with map-side combine, so a word as frequent as it may be is a row a task. Two words one
edit apart agree outside of the edited place: with the shorter one cut into PARTS parts, all parts but one
stand unchanged, counted from the front before the edit and from the back behind it. Each word is posted
under its parts but one, for its own length and (as the longer word of a pair) for one less; near words
meet in the block of such a key. A block with more than BLOCK words is not one task's group: its words are
posted again by parts of the part that was left open, down to one open letter, so that blocks stay small
whatever the vocabulary.

In a block, the words at each (position, letter) are a bitset, an arbitrary-precision integer over the
block's words. A word is matched against all of them at once: its letters drive recurrences on four sets,
those without an error so far and those with one replaced, one added (the positions shifted up) or one
missing letter (shifted down). What is left at the end differs by exactly one edit.

A pair may meet in several blocks, but counts in the first only: the one whose open part comes first among
all keys that both share, at every level. So near words are counted and the best one chosen where they
meet, and only a row a word and block is shuffled, never a pair.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, stage
from .common import id_and_text, ship

PARTS = 3
BLOCK = 4096
LETTERS, LEAST, RATIO = 5, 3, 2
DROP_EACH = 97

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_POST = pa.schema([("k", pa.string()), ("path", pa.list_(pa.int32())), ("word", pa.string()), ("n", pa.int64()), ("open", pa.int32())])
_POST_DDL = "k string, path array<int>, word string, n long, open int"
_FOUND_DDL = "word string, n_near long, best_n long, best string"


# ------------------------------------------------------------------ words

def words(docs: DataFrame, letters: int = LETTERS, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of Latin letters, A-Z in lower case, of at least so many code points and occurrences.

    Where 97 divides the CRC-32 h of `<doc_id>:<run>`, the run loses its code point h % length: typing
    errors at a known rate. A row without an id has an empty one; a null text has no words.
    """
    rows = id_and_text(docs, id_col, text_col).select(
        F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":")).alias("lead"),
        F.explode(F.regexp_extract_all(F.translate("text", _UPPER, _UPPER.lower()), F.lit("([a-zÀ-ÿ]+)"))).alias("run"))
    h = F.crc32(F.concat("lead", "run"))
    size = F.length("run")
    rows = rows.withColumn("at", F.when(h % DROP_EACH == 0, (h % size).cast("int")))
    run, at = F.col("run"), F.col("at")
    word = F.when(at.isNull(), run).otherwise(F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.lit(1 << 30))))
    return (rows.select(word.alias("word")).where(F.length("word") >= letters).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= least))


# ------------------------------------------------------------------ keys

def _cuts(size: int) -> list[tuple[int, int]]:
    """Where the parts of an open stretch of the shorter word's letters begin and end; no more parts than letters."""
    parts = min(PARTS, size)
    return [(size * p // parts, size * (p + 1) // parts) for p in range(parts)]


def _open(word: str, path: list[int]) -> tuple[int, int]:
    """The open stretch, after the choices of a path, of the shorter word's length: offsets in it.

    path[0] is the shorter word's length, the others are the parts left open, level by level.
    """
    lo, hi = 0, path[0]
    for p in path[1:]:
        a, b = _cuts(hi - lo)[p]
        lo, hi = lo + a, lo + b
    return lo, hi


def _key(word: str, size: int, lo: int, hi: int) -> tuple[str, str]:
    """What must agree when a pair's edit lies in [lo, hi) of the shorter word: letters before, and behind from the back."""
    return word[:lo], word[len(word) - (size - hi):]


def _posts(word: str, n: int, path: list[int]):
    """The word's posts one level below a path."""
    lo, hi = _open(word, path)
    for p, (a, b) in enumerate(_cuts(hi - lo)):
        front, back = _key(word, path[0], lo + a, lo + b)
        yield f"{path[0]} {lo + a} {lo + b} {front} {back}", [*path, p], word, n, b - a


def _shares_earlier(x: str, y: str, path: list[int]) -> bool:
    """Whether the two words of a block also meet in a block that comes before it."""
    size = path[0]
    for depth in range(1, len(path)):
        lo, hi = _open(x, path[:depth])
        for a, b in _cuts(hi - lo)[: path[depth]]:
            if _key(x, size, lo + a, lo + b) == _key(y, size, lo + a, lo + b):
                return True
    return False


def _first_posts(batches):
    for rows in batches:
        for lo in range(0, rows.num_rows, 2048):
            part = rows.slice(lo, 2048)
            out = [post for w, n in zip(part.column(0).to_pylist(), part.column(1).to_pylist())
                   for size in (len(w) - 1, len(w)) if size for post in _posts(w, n, [size])]
            yield _batch(out, _POST)


def _next_posts(batches):
    for rows in batches:
        for lo in range(0, rows.num_rows, 2048):
            part = rows.slice(lo, 2048).to_pydict()
            yield _batch([post for path, w, n in zip(part["path"], part["word"], part["n"]) for post in _posts(w, n, path)], _POST)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


# ------------------------------------------------------------------ a block

class PositionIndex:
    """Bitsets over a list of words: those with a letter at a position, and those of a length."""

    def __init__(self, words: list[str]):
        self.words, self.at, self.long = words, {}, {}
        self.all = (1 << len(words)) - 1
        at, long = self.at, self.long
        for i, w in enumerate(words):
            bit = 1 << i
            long[len(w)] = long.get(len(w), 0) | bit
            for spot in enumerate(w):
                at[spot] = at.get(spot, 0) | bit

    def one_edit(self, word: str) -> int:
        """The set of words that differ from the word by exactly one added, missing or replaced letter."""
        at, every = self.at.get, self.all
        exact, replaced, added, missing = every, 0, 0, 0
        for i, c in enumerate(word):
            here = at((i, c), 0)
            missing = exact | missing & at((i - 1, c), 0)             # c is in the word only: their letters lag by one
            replaced = replaced & here | exact & ~here
            added = (added | exact) & at((i + 1, c), 0)               # a letter of theirs before c: they lead by one
            exact &= here
        size = len(word)
        added |= exact
        # a replaced or added letter must be there: lengths say so
        return (replaced & self.long.get(size, 0) | added & self.long.get(size + 1, 0) | missing & self.long.get(size - 1, 0)) & every


def _bits(found: int):
    while found:
        low = found & -found
        yield low.bit_length() - 1
        found ^= low


def near_in_block(block: list[tuple[str, int]], path: list[int]) -> list[tuple[str, int, int, str]]:
    """(word, near words counted here, largest n among them, the word that has it), for words of a block that have any.

    Only pairs whose shorter word has the path's length, and that meet in no earlier block.
    """
    block = sorted(block)
    index, out, size = PositionIndex([w for w, _ in block]), [], path[0]
    for w, _ in block:
        found = index.one_edit(w)
        if len(w) > size:
            found &= index.long.get(size, 0)
        near = [block[i] for i in _bits(found) if not _shares_earlier(w, block[i][0], path)]
        if near:
            most, best = min((-n, x) for x, n in near)
            out.append((w, len(near), -most, best))
    return out


def _in_blocks(batches):
    """Blocks of rows sorted by key, one after another; a block has at most BLOCK words."""
    key, path, block = None, None, []
    for rows in batches:
        out = []
        for k, p, w, n in zip(*(rows.column(i).to_pylist() for i in range(4))):
            if k != key:
                if len(block) > 1:
                    out += near_in_block(block, path)
                key, path, block = k, p, []
            block.append((w, n))
        yield _batch(out, _FOUND)
    if len(block) > 1:
        yield _batch(near_in_block(block, path), _FOUND)


_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


# ------------------------------------------------------------------ Spark

def near_words(counted: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best_n, best) for the words, of distinct (word, n), that have a near one."""
    spark = counted.sparkSession
    ship(spark)
    posts = counted.select("word", "n").mapInArrow(_first_posts, _POST_DDL)
    found = None
    while True:
        posts = stage(posts, "posts")
        # a block with one letter left open is final: its words differ in that letter, or in one more
        sizes = posts.where("open > 1").groupBy("k").agg(F.count("*").alias("m"))
        large = stage(sizes.where(F.col("m") > block), "large-blocks").select("k")
        any_large = large.count() > 0
        small = posts.join(large, "k", "left_anti") if any_large else posts
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        here = small.repartition(parts, "k").sortWithinPartitions("k").mapInArrow(_in_blocks, _FOUND_DDL)
        path = scratch_path(spark, "near-words")
        here.write.parquet(path)
        here = spark.read.parquet(path)
        found = here if found is None else found.union(here)
        if not any_large:
            break
        posts = posts.join(large, "k", "left_semi").mapInArrow(_next_posts, _POST_DDL)
    best = F.min_by(F.struct("best_n", "best"), F.struct((-F.col("best_n")).alias("m"), "best"))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", F.col("b.best_n").alias("best_n"), F.col("b.best").alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for rows (word, form): the end of the chain of forms, by pointer doubling."""
    now = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stage(now.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                           F.col("further").isNotNull().alias("moved")), "roots")
        now = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return now


def group_variants(counted: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of distinct (word, n).

    form: the near word of largest n (ties: the smallest in code-point order) if that is at least ratio
    times the word's n, else null; root: where the chain of forms ends, the word itself without one (n grows
    along it, so it ends). An empty table gives no rows.
    """
    near = near_words(counted, block)
    joined = stage(counted.select("word", "n").join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best")).alias("form"),
        F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best_n")).alias("form_n")), "forms")
    ends = roots(joined.where("form is not null"))
    return (joined.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return group_variants(stage(words(spark.read.parquet(f"{sf_dir}/documents.parquet")), "words"))
