"""The pipeline's stages, each against what it must do to its own input."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from vigilo.session import stage


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "language id", "minhash near-dedup",
                                                      "benchmark decontamination", "best-fit packing"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, seen = docs.columns, []
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF_SMALL), "test")
        seen.append(docs)
        if name != "best-fit packing":
            assert docs.columns == columns
    bench = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    before, after = ({r.doc_id: r.text for r in d.collect()} for d in seen[2:4])
    assert set(before) - set(after) == {i for i, t in before.items() if any(b in t for b in bench)}
    assert max(Counter(before.values()).values()) == 1                   # no two copies
    pieces = seen[4].collect()
    assert {r.doc_id for r in pieces} == set(after)


def test_stages_on_odd_rows(spark):
    """Nulls in any column, empty, blank and long texts, repeated rows, ties and clashing extra columns; then no rows at all."""
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    ids = 10 ** 6
    text = "the quick brown fox of the north went over the hill and far away with all of the others in the evening "
    odd = [(ids, None, None, None, None), (ids + 1, "", "en", "a", 0), (ids + 2, " \n\t ", "en", "a", 4), (None, "no id but words", "en", None, None),
           (ids + 3, text, "en", "a", 1), (ids + 3, text, "en", "a", 1), (ids + 4, text, "en", "a", 1), (ids + 5, "word " * 40_000, "en", "a", 1)]
    names = ["shard", "token", "n", "doc", "length", "number", "kept", "score", "lang_pred"]
    docs = table.unionByName(spark.createDataFrame(odd, table.schema)).select("*", *[F.lit(7).alias(n) for n in names])
    for empty in (False, True):
        at = docs.where("false") if empty else docs
        for name, function in corpus_pipeline.STAGES:
            before, at = at, stage(function(spark, at, SF_SMALL), "test")
            rows = at.where(f"doc_id >= {ids} or doc_id is null").collect()
            if name == "best-fit packing":
                assert {r.doc_id for r in rows} == {r.doc_id for r in before.where(f"doc_id >= {ids} or doc_id is null").collect()}
                continue
            assert at.columns == docs.columns and (not empty or at.count() == 0)
            if name == "language id":
                assert not {r.doc_id for r in rows} & {ids, ids + 1, ids + 2}        # without a letter
            if name == "minhash near-dedup":
                assert len([r for r in rows if r.text == text]) <= 1
