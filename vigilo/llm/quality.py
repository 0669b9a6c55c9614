"""Quality by importance resampling with hashed n-gram models.

Two bag models over hashed word unigrams and bigrams: one of the target (documents labelled good), one
of all raw text. A document's importance weight is the ratio of its probabilities under both, taken
per n-gram so that long texts do not outweigh short ones, and documents are drawn by Gumbel top-k: the
k highest sums of log weight and Gumbel noise, k being the number of documents whose weight is on the
good side of the cut that best parts labelled good from bad ones.

The raw model counts every text in full. Labels are read from a bounded sample (LABELLED rows, the
first by a hash of the id): one half feeds the target model, the other half finds the cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from . import scan
from .common import id_and_text, ship

LABELLED = 20_000
BITS = 17                # buckets of the models, as a power of two
PRIOR = 4.0              # target n-grams that every bucket is thought to have as raw text has them
GOOD_WEIGHT = 20.0       # losing a share of good documents costs so many times as much as keeping that share of bad ones
STEADY = 100.0           # n-grams of average weight that every document is thought to have besides
SHARPNESS = 256.0        # log weight for each unit of the mean log ratio
STEP = 1 << 20           # keys are compared as multiples of 1 / STEP

_FACTORS = scan.mix(np.array([11, 12], np.uint64)) | np.uint64(1)
_COUNTS_DDL = "bucket int, raw long, target long"
_COUNTS = pa.schema([("bucket", pa.int32()), ("raw", pa.int64()), ("target", pa.int64())])
_SCORED = pa.schema([("doc_id", pa.int64()), ("n_grams", pa.int64()), ("mean_ratio", pa.float64()), ("key", pa.int64())])
_SCORED_DDL = "doc_id long, n_grams long, mean_ratio double, key long"


def _grams(part: scan.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every unigram and bigram."""
    w = scan.words(part.buf, part.starts, scan.NOT_SPACE)
    owner = w.owner()
    pair = scan.mix(w.h[:-1] * _FACTORS[0] + w.h[1:] * _FACTORS[1])
    inside = owner[:-1] == owner[1:]
    bucket = np.concatenate([w.h, pair[inside]]) >> np.uint64(64 - BITS)
    return bucket.astype(np.int64), np.concatenate([owner, owner[:-1][inside]])


def _count(batches):
    raw, target = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
    for part in scan.slices(batches):
        bucket, owner = _grams(part)
        good = part.rows.column(part.rows.schema.get_field_index("good")).to_numpy(zero_copy_only=False).astype(bool)
        raw += np.bincount(bucket, minlength=1 << BITS)
        target += np.bincount(bucket[good[owner]], minlength=1 << BITS)
    seen = np.flatnonzero(raw)
    yield scan.batch(_COUNTS, seen, raw[seen], target[seen])


class QualityModel:
    """Log ratio of each bucket, and the key from which documents are kept."""

    def __init__(self, ratio: np.ndarray, least_key: int | None = None, seed: int = 0):
        self.ratio, self.least_key, self.seed = ratio, least_key, seed

    def scores(self, part: scan.Slice, ids: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """n-grams, mean log ratio and Gumbel key (times STEP) of each text."""
        bucket, owner = _grams(part)
        n = np.bincount(owner, minlength=len(part))
        mean = np.bincount(owner, self.ratio[bucket], len(part)) / (n + STEADY)
        who = np.asarray(ids.cast(pa.int64()).fill_null(-1)).astype(np.int64).view(np.uint64)
        u = ((scan.mix(who + np.uint64(self.seed * 2 + 1)) >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)
        return n, mean, np.floor((SHARPNESS * mean - np.log(-np.log(u))) * STEP).astype(np.int64)

    def score_batches(self, batches):
        for part in scan.slices(batches):
            n, mean, key = self.scores(part, part.rows.column(0))
            yield scan.batch(_SCORED, part.rows.column(0), n, mean, key)

    def kept_rows(self, id_col: str, text_col: str):
        """Rows of any columns, those of rejected documents left out."""
        def run(batches):
            for part in scan.slices(batches, text_col):
                ids = part.rows.column(part.rows.schema.get_field_index(id_col))
                yield part.rows.filter(pa.array(self.scores(part, ids)[2] >= self.least_key))
        return run


def _cut(means: np.ndarray, good: np.ndarray) -> float:
    """The mean ratio that parts good from bad best (GOOD_WEIGHT x share of good above + share of bad below), the lowest such."""
    if good.all() or not good.any():
        return -np.inf
    order = np.argsort(means, kind="stable")
    above = 1 - np.append(0, np.cumsum(good[order])) / good.sum()
    below = np.append(0, np.cumsum(~good[order])) / (~good).sum()
    fit = GOOD_WEIGHT * above + below
    fit[1:-1][means[order][1:] == means[order][:-1]] = -1      # no cut between equal values
    i = int(np.argmax(fit))
    return -np.inf if i == 0 else np.inf if i == len(order) else float((means[order][i - 1] + means[order][i]) / 2)


def _least_key(scored: DataFrame, k: int) -> int:
    """The k-th highest key: first its block of 2**16 steps, then the key in the block; both counts are bounded."""
    left, at = k, None
    for shift in (16, 0):
        keys = scored if at is None else scored.where(F.shiftright("key", 16) == at)
        counts = keys.groupBy(F.shiftright("key", shift).alias("b")).agg(F.count("*").alias("n")).collect()
        for b, n in sorted(((r.b, r.n) for r in counts), reverse=True):
            at = b
            if left <= n:
                break
            left -= n
    return at


def fit(docs: DataFrame, labels: DataFrame, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> tuple[QualityModel, DataFrame]:
    """The model with its least key, and all documents' scores.

    Labels without an id or a quality are passed over; an id labelled twice counts as its lowest label.
    """
    docs = id_and_text(docs, id_col, text_col)
    sample = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
              .dropna().groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED))
    sample = stage(sample.withColumn("fits", F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)) == 0), "labelled")
    small = F.broadcast(sample.where("fits and quality = 1").select("doc_id", F.lit(True).alias("good")))   # LABELLED rows at most
    flagged = docs.join(small, "doc_id", "left").select("doc_id", "text", F.coalesce("good", F.lit(False)).alias("good"))
    counts = flagged.mapInArrow(_count, _COUNTS_DDL).groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for r in counts.collect():                                     # 2**BITS rows at most
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    ratio = np.zeros(1 << BITS, np.float32)
    if target.any():
        ratio = np.log((target + PRIOR) / (target.sum() * raw / raw.sum() + PRIOR)).astype(np.float32)
    model = QualityModel(ratio, seed=seed)
    scored = stage(docs.mapInArrow(model.score_batches, _SCORED_DDL), "scored")
    judged = scored.join(F.broadcast(sample.where("not fits")), "doc_id").select("mean_ratio", "quality").limit(4 * LABELLED).collect()
    cut = _cut(np.array([r.mean_ratio for r in judged]), np.array([r.quality == 1 for r in judged], bool)) if target.any() else -np.inf
    cut = -1e300 if cut == -np.inf else 1e300 if cut == np.inf else cut
    k = scored.where(F.col("mean_ratio") >= cut).count()
    model.least_key = _least_key(scored, k) if k else np.iinfo(np.int64).max
    return model, scored


def resample(docs: DataFrame, labels: DataFrame, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_grams, log_weight, gumbel_key, kept.

    Null and empty texts have no n-grams and average weight; ties at the k-th key are all kept, so
    repeated rows fare alike; rows with a null id are drawn with one noise. Without labelled good
    documents every document is kept; an empty table gives no rows.
    """
    model, scored = fit(docs, labels, seed, id_col, text_col)
    return scored.select("doc_id", "n_grams", (F.col("mean_ratio") * SHARPNESS).alias("log_weight"),
                         (F.col("key") / STEP).alias("gumbel_key"), (F.col("key") >= model.least_key).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of the drawn documents, with all their columns."""
    ship(docs.sparkSession)
    model, _ = fit(docs, labels, seed, id_col, text_col)
    return docs.mapInArrow(model.kept_rows(id_col, text_col), docs.schema)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
