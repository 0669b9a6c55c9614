"""Token counts of whole texts by compiled transducers (see transducer)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import scan
from .common import id_and_text
from .transducer import MAX_KEPT, default_path, kept_counts, open_merger, open_tokenizer

LIMIT = 1024

_COUNTED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])
_COUNTED_DDL = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def slice_counts(part: scan.Slice, path: str) -> np.ndarray:
    """Tokens of each text of a slice."""
    splitter, merger = open_tokenizer(path)[1], open_merger(path)
    kept = kept_counts(path)
    if kept.n > MAX_KEPT:
        kept.__init__()
    begin = splitter.split(part)
    end = np.append(begin[1:], len(part.buf))
    own = np.ones(len(part.buf) + 1, bool)
    own[part.ends] = False
    begin, end = begin[own[begin]], end[own[begin]]
    if not len(begin):
        return np.zeros(len(part), np.int64)
    h = scan.span_hashes(part.buf, begin, end)
    n = kept.get(h)
    new = np.flatnonzero(n < 0)
    if len(new):
        keys, first = np.unique(h[new], return_index=True)
        raw = part.buf.tobytes()
        special = set(splitter.special)
        pieces = [raw[a:b] for a, b in zip(begin[new[first]].tolist(), end[new[first]].tolist())]
        kept.put(keys, np.array([1 if p in special else merger.count(p) for p in pieces], np.int64))
        n[new] = kept.get(h[new])
    total = np.append(0, np.cumsum(n))
    return total[np.searchsorted(begin, part.ends)] - total[np.searchsorted(begin, part.starts)]


def _count(path: str, limit: int):
    def run(batches):
        for part in scan.slices(batches):
            n = slice_counts(part, path)
            yield scan.batch(_COUNTED, part.rows.column(0), part.ends - part.starts, n, n > limit)
        kept_counts(path).__init__()
        open_merger(path).forget()
        scan.give_back()
    return run


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens above the limit).

    path: a byte-level BPE file of the tokenizers library, there on every executor. A null text is
    empty and has no tokens; special strings count as the library's default counts them; null ids and
    repeated rows are counted each; an empty table gives no rows.
    """
    return id_and_text(docs, id_col, text_col).mapInArrow(_count(path or default_path(), limit), _COUNTED_DDL)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
