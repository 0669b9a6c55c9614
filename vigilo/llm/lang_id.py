"""Language identification by a linear-chain conditional random field over words.

Every word of a text gets a score for each language from hashed features: byte trigrams with word
boundaries, prefix and suffix of three bytes, and the word itself (lexicon). Learned transitions link
neighbouring words, and forward-backward gives each word its probabilities, so a text that switches
languages is labelled word by word. A document's prediction is the language with the highest mean
probability over its words.

Training words come from a bounded sample (DOCS_PER_LANG documents a language, SAMPLE in all, SNIPPETS
runs of SNIPPET_WORDS words each, spread over the whole text); training chains join runs of different
documents, so that transitions see switches. A run is cut at SNIPPET_BYTES, for texts without spaces.

A text is one chain however long it is. Its words are worked on in chunks of CHUNK: every chunk's
transition product gives the probabilities at the chunks' borders, and with those forward-backward runs
over the chunks side by side, with the results of one run over the whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import stage
from . import scan
from .common import id_and_text, ship

DOCS_PER_LANG, SAMPLE, SNIPPETS, SNIPPET_WORDS, SNIPPET_BYTES = 300, 20_000, 8, 12, 1024
CHUNK = 64               # words worked on at once; results don't depend on it
HASH_BITS = 16
ROUNDS, RATE, DECAY = 40, 0.5, 1e-4
UNKNOWN = "und"

_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True

_PREDICTED = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
_PREDICTED_DDL = "doc_id long, lang_pred string, score double"
_SPANS = pa.schema([("doc_id", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("lang", pa.string()), ("score", pa.float64())])
_SPANS_DDL = "doc_id long, first_word long, last_word long, lang string, score double"
_SNIPPET = pa.schema([("lang", pa.string()), ("snippet", pa.string())])


def _slot(code: np.ndarray, kind: int) -> np.ndarray:
    """A feature's place: its kind's part of the table, and a hash within it."""
    return ((code.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(32 - HASH_BITS)).astype(np.int64) | kind << HASH_BITS


def _features(buf: np.ndarray, w: scan.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram places by byte, the bounds of each word's trigrams, and the three other places of each word."""
    low = scan.LOWER[buf]
    plain = np.concatenate([[0x20], np.where(_LETTERS[low], low, 0x20), [0x20, 0x20, 0x20]]).astype(np.uint32)
    tri = _slot(plain[:-2] << np.uint32(16) | plain[1:-1] << np.uint32(8) | plain[2:], 0)      # tri[p] begins a byte before p
    bounds = np.stack([w.s, w.e], 1).ravel()
    s, e, p = w.s + 1, w.e + 1, plain
    two, three = w.e - w.s > 1, w.e - w.s > 2
    head = p[s] << np.uint32(16) | np.where(two, p[s + 1], 0).astype(np.uint32) << np.uint32(8) | np.where(three, p[s + 2], 0).astype(np.uint32)
    tail = p[e - 1] << np.uint32(16) | np.where(two, p[e - 2], 0).astype(np.uint32) << np.uint32(8) | np.where(three, p[e - 3], 0).astype(np.uint32)
    return tri, bounds, np.stack([_slot(head, 1), _slot(tail, 2), _slot((w.h >> np.uint64(32)).astype(np.uint32), 3)])


def _word_scores(weights: np.ndarray, buf: np.ndarray, w: scan.Words) -> np.ndarray:
    """Score of each language (rows) for each word."""
    out = np.zeros((len(weights), len(w.h)), np.float32)
    if len(w.h):
        tri, bounds, rest = _features(buf, w)
        for k, row in enumerate(weights):
            out[k] = np.add.reduceat(row[tri], bounds)[0::2] + row[rest].sum(0)
    return out


def _expected(score: np.ndarray) -> np.ndarray:
    return np.exp(score - score.max(-1, keepdims=True))


def forward_backward(score: np.ndarray, length: np.ndarray, start: np.ndarray, step: np.ndarray,
                     entry: np.ndarray | None = None, leave: np.ndarray | None = None):
    """Probabilities of each label at each word, and expected transitions.

    score: chains x words x labels; length: words of each chain, the rest is padding; start and step:
    log weights of first labels and of transitions. For parts of longer chains, entry and leave (chains x
    labels) are what the words before tell of the first word, and the words behind of the last.
    """
    chains, words, labels = score.shape
    e = _expected(score)
    go = np.exp(step - step.max())
    entry = np.exp(start - start.max()) if entry is None else entry
    leave = np.ones((chains, labels)) if leave is None else leave
    alpha, beta = np.empty_like(e), np.repeat(leave[:, None], words, axis=1)
    a = entry * e[:, 0]
    alpha[:, 0] = a = a / a.sum(1, keepdims=True)
    for t in range(1, words):
        a = (a @ go) * e[:, t]
        a /= np.maximum(a.sum(1, keepdims=True), 1e-30)
        alpha[:, t] = a
    moves = np.zeros((labels, labels))
    for t in range(words - 2, -1, -1):
        inside = (t + 1 < length)[:, None]
        ahead = e[:, t + 1] * beta[:, t + 1]
        b = ahead @ go.T
        pair = (alpha[:, t] * b).sum(1, keepdims=True)
        moves += ((alpha[:, t] * inside / np.maximum(pair, 1e-30)).T @ ahead) * go
        beta[:, t] = np.where(inside, b / np.maximum(b.sum(1, keepdims=True), 1e-30), leave)
    gamma = alpha * beta
    gamma /= np.maximum(gamma.sum(2, keepdims=True), 1e-30)
    gamma[np.arange(words)[None, :] >= length[:, None]] = 0
    return gamma, moves


def _products(score: np.ndarray, length: np.ndarray, step: np.ndarray) -> np.ndarray:
    """For each chunk the weight of reaching each last label from each first label, up to a factor."""
    chunks, words, labels = score.shape
    e, go = _expected(score), np.exp(step - step.max())
    out = np.eye(labels) * e[:, 0][:, None]
    for t in range(1, words):
        ahead = (out @ go) * e[:, t][:, None]
        ahead /= np.maximum(ahead.max((1, 2), keepdims=True), 1e-300)
        out = np.where((t < length)[:, None, None], ahead, out)
    return out


def _borders(products: np.ndarray, first: np.ndarray, count: np.ndarray, start: np.ndarray, step: np.ndarray):
    """(entry, leave) of every chunk; a text's are first to first + count - 1, and all texts advance together."""
    go = np.exp(step - step.max())
    entry = np.tile(np.exp(start - start.max()), (len(products), 1))
    leave = np.ones_like(entry)
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    for c in range(1, int(count[0])):
        at = first[: np.searchsorted(-count, -c)] + c            # texts of more than c chunks
        ahead = np.einsum("il,ilm->im", entry[at - 1], products[at - 1]) @ go
        entry[at] = ahead / np.maximum(ahead.sum(1, keepdims=True), 1e-300)
    for c in range(int(count[0]) - 1, 0, -1):
        at = first[: np.searchsorted(-count, -c)] + c
        behind = np.einsum("ilm,im->il", products[at], leave[at]) @ go.T
        leave[at - 1] = behind / np.maximum(behind.sum(1, keepdims=True), 1e-300)
    return entry, leave


class LangModel:
    """Weights of features (languages x places), of first labels and of transitions."""

    def __init__(self, langs: list[str], weights: np.ndarray, start: np.ndarray, step: np.ndarray):
        self.langs, self.weights, self.start, self.step = langs, weights, start, step

    @classmethod
    def train(cls, snippets: list[tuple[str, str]], seed: int = 5) -> "LangModel":
        """Maximum likelihood by adaptive gradient steps over all chains."""
        langs = sorted({lang for lang, _ in snippets})
        n_lang, places = len(langs), 4 << HASH_BITS
        weights, start, step = np.zeros((n_lang, places), np.float32), np.zeros(n_lang), np.zeros((n_lang, n_lang))
        if n_lang < 2:
            return cls(langs, weights, start, step)
        order = np.random.default_rng(seed).permutation(len(snippets))
        raw = [snippets[i][1].encode() for i in order]
        size = np.array([len(x) for x in raw], np.int64)
        buf = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
        ends = np.cumsum(size + 1) - 1
        w = scan.words(scan.LOWER[buf], ends - size, _LETTERS)
        truth = np.repeat(np.array([langs.index(snippets[i][0]) for i in order]), w.counts())
        chains = -(-len(truth) // (2 * SNIPPET_WORDS))
        length = np.full(chains, 2 * SNIPPET_WORDS)
        length[-1] = len(truth) - (chains - 1) * 2 * SNIPPET_WORDS
        tri, bounds, rest = _features(buf, w)
        n_tri = w.e - w.s
        at = np.repeat(w.s - np.append(0, np.cumsum(n_tri)[:-1]), n_tri) + np.arange(n_tri.sum())
        place = np.concatenate([tri[at], rest.ravel()])
        word = np.concatenate([np.repeat(np.arange(len(truth)), n_tri), np.tile(np.arange(len(truth)), 3)])
        used, local = np.unique(place, return_inverse=True)
        small, squares = np.zeros((n_lang, len(used))), np.full((n_lang, len(used)), 1e-6)
        s2, t2 = np.full(n_lang, 1e-6), np.full((n_lang, n_lang), 1e-6)
        hot = np.zeros((len(truth), n_lang))
        hot[np.arange(len(truth)), truth] = 1
        padded = chains * 2 * SNIPPET_WORDS
        full = np.zeros((padded, n_lang))
        inner = np.arange(1, len(truth)) % (2 * SNIPPET_WORDS) != 0
        seen = np.zeros((n_lang, n_lang))
        np.add.at(seen, (truth[:-1][inner], truth[1:][inner]), 1)
        for _ in range(ROUNDS):
            for k in range(n_lang):
                full[: len(truth), k] = np.bincount(word, small[k][local], len(truth))
            gamma, moves = forward_backward(full.reshape(chains, -1, n_lang), length, start, step)
            off = hot - gamma.reshape(padded, n_lang)[: len(truth)]
            for k in range(n_lang):
                g = np.bincount(local, off[word, k], len(used)) - DECAY * len(truth) * small[k] / 1000
                squares[k] += g * g
                small[k] += RATE * g / np.sqrt(squares[k])
            first = off.reshape(-1, n_lang)[:: 2 * SNIPPET_WORDS].sum(0)
            s2 += first * first
            start += RATE * first / np.sqrt(s2)
            g = seen - moves
            t2 += g * g
            step += RATE * g / np.sqrt(t2)
        weights[:, used] = small
        return cls(langs, weights, start, step)

    def posteriors(self, part: scan.Slice, w: scan.Words):
        """Blocks of (text of each chunk, place of each of its words, words a chunk, probabilities: chunks x words x languages)."""
        counts, n_lang = w.counts(), len(self.langs)
        emitted = _word_scores(self.weights, part.buf, w).T
        chunks = -(-counts // CHUNK)
        owner = np.repeat(np.arange(len(counts)), chunks)
        begin = np.cumsum(chunks) - chunks
        first = w.first[owner] + (np.arange(len(owner)) - begin[owner]) * CHUNK
        length = np.minimum(CHUNK, w.first[owner + 1] - first)

        def blocks(of: np.ndarray, cells: int):
            of = of[np.argsort(length[of], kind="stable")]
            size = max(1, cells // (CHUNK * n_lang))
            for i in range(0, len(of), size):
                at = of[i: i + size]
                place = np.minimum(first[at][:, None] + np.arange(int(length[at].max())), len(w.h) - 1)
                yield at, place, emitted[place].astype(float)

        entry, leave = np.tile(np.exp(self.start - self.start.max()), (len(owner), 1)), np.ones((len(owner), n_lang))
        several = np.flatnonzero(chunks[owner] > 1)
        if len(several):
            products = np.empty((len(owner), n_lang, n_lang))
            for at, _, score in blocks(several, 1 << 19):
                products[at] = _products(score, length[at], self.step)
            long = np.flatnonzero(chunks > 1)
            e, q = _borders(products, begin[long], chunks[long], self.start, self.step)
            entry[several], leave[several] = e[several], q[several]
        for at, place, score in blocks(np.arange(len(owner)), 1 << 19):
            yield owner[at], place, length[at], forward_backward(score, length[at], self.start, self.step, entry[at], leave[at])[0]

    def predict(self, part: scan.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language of each text (-1: unknown), its mean probability over the words, and that of each word's own best language."""
        n = len(part)
        best, score, sure = np.full(n, -1), np.zeros(n), np.zeros(n)
        if not self.langs:
            return best, score, sure
        w = scan.words(scan.LOWER[part.buf], part.starts, _LETTERS)
        counts = w.counts()
        total = np.zeros((n, len(self.langs)))
        if len(self.langs) == 1:
            total[:, 0] = sure[:] = counts
        elif len(w.h):
            for owner, _, _, gamma in self.posteriors(part, w):
                np.add.at(total, owner, gamma.sum(1))
                np.add.at(sure, owner, gamma.max(2).sum(1))
        has = np.zeros(n, bool)
        letters = np.append(0, np.cumsum(_ASCII_LETTER[part.buf]))
        has[:] = letters[part.ends] > letters[part.starts]
        for i in np.flatnonzero(~has & (counts > 0)):
            has[i] = any(c.isalpha() for c in part.buf[part.starts[i]: part.ends[i]].tobytes().decode())
        best[has] = total[has].argmax(1)
        score[has] = np.clip(total[has].max(1) / np.maximum(counts[has], 1), 0, 1)
        return best, score, np.where(has, np.clip(sure / np.maximum(counts, 1), 0, 1), 0)

    def word_labels(self, part: scan.Slice) -> tuple[scan.Words, np.ndarray, np.ndarray]:
        """The words, the most probable language of each (-1 where none was learned), and its probability."""
        w = scan.words(scan.LOWER[part.buf], part.starts, _LETTERS)
        label, share = np.full(len(w.h), 0 if self.langs else -1), np.full(len(w.h), 1.0 if self.langs else 0.0)
        if len(self.langs) > 1 and len(w.h):
            for _, place, length, gamma in self.posteriors(part, w):
                inside = np.arange(place.shape[1]) < length[:, None]
                label[place[inside]] = gamma.argmax(2)[inside]
                share[place[inside]] = gamma.max(2)[inside]
        return w, label, share

    def span_batches(self, batches):
        names = pa.array([*self.langs, UNKNOWN], pa.string())
        for part in scan.slices(batches):
            w, label, share = self.word_labels(part)
            if not len(label):
                continue
            owner = w.owner()
            first = np.flatnonzero(np.append(True, (label[1:] != label[:-1]) | (owner[1:] != owner[:-1])))
            size = np.diff(np.append(first, len(label)))
            place = first - w.first[owner[first]]
            yield scan.batch(_SPANS, part.rows.column(0).take(pa.array(owner[first])), place, place + size - 1,
                             names.take(pa.array(np.where(label[first] < 0, len(self.langs), label[first]))), np.clip(np.add.reduceat(share, first) / size, 0, 1))

    def predict_batches(self, batches):
        names = pa.array([*self.langs, UNKNOWN], pa.string())
        for part in scan.slices(batches):
            best, score, _ = self.predict(part)
            yield scan.batch(_PREDICTED, part.rows.column(0), names.take(pa.array(np.where(best < 0, len(self.langs), best))), score)

    def kept_rows(self, text_col: str, least: float):
        def run(batches):
            for part in scan.slices(batches, text_col):
                best, _, sure = self.predict(part)
                yield part.rows.filter(pa.array((best >= 0) & (sure >= least))) if self.langs else part.rows
        return run


def _snippets(batches):
    for part in scan.slices(batches):
        w = scan.words(part.buf, part.starts, scan.NOT_SPACE)
        lang = part.rows.column(part.rows.schema.get_field_index("lang")).to_pylist()
        out_l, out_s = [], []
        for i in range(len(part)):
            a, b = w.first[i], w.first[i + 1]
            runs = min(SNIPPETS, -(-(b - a) // SNIPPET_WORDS))
            for j in range(runs):
                lo = a + (b - a - SNIPPET_WORDS) * j // max(1, runs - 1) if b - a > SNIPPET_WORDS else a
                hi = min(lo + SNIPPET_WORDS, b)
                out_l.append(lang[i])
                run = part.buf[w.s[lo]: min(w.e[hi - 1], w.s[lo] + SNIPPET_BYTES)].tobytes()
                out_s.append(run.decode(errors="ignore"))           # a cut character is left out
        yield scan.batch(_SNIPPET, out_l, out_s)


def _held_out(col):
    return F.coalesce(F.crc32(col.cast("long").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LangModel:
    """Trained on documents with a text and a language that are not held out."""
    ship(docs.sparkSession)
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                        F.col(lang_col).cast("string").alias("lang")).where("doc_id is not null and text is not null and lang is not null")
    named = named.where(~_held_out(F.col("doc_id")))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    picked = (named.select("doc_id", "lang").distinct().withColumn("nth", nth).where(F.col("nth") <= DOCS_PER_LANG)
              .orderBy("nth", "lang").limit(SAMPLE).select("doc_id", "lang"))
    rows = (named.join(F.broadcast(stage(picked, "picked")), ["doc_id", "lang"])       # SAMPLE rows at most
            .groupBy("doc_id", "lang").agg(F.min("text").alias("text")))
    found = rows.mapInArrow(_snippets, "lang string, snippet string").collect()
    return LangModel.train(sorted((r.lang, r.snippet) for r in found))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    lang_pred is a language of the training documents, or 'und' with score 0 for a null text, a text
    without a letter, or where no language was learned; score is the mean word probability of the
    prediction, ties go to the language first in the alphabet. Null ids are not held out and train
    nothing; of rows that repeat an id and a language, one trains. An empty table gives no rows.
    """
    model = fit(docs, id_col, text_col, lang_col)
    out = id_and_text(docs, id_col, text_col).mapInArrow(model.predict_batches, _PREDICTED_DDL)
    return out.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def language_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per longest run of words of one language: doc_id, first_word, last_word (from 0), lang, score.

    Words are runs of ASCII letters and non-ASCII characters; score is the mean probability of the run's
    words. Null texts and texts without words give no rows; where no language was learned lang is 'und' and
    score 0. Repeated rows and null ids are labelled each.
    """
    model = fit(docs, id_col, text_col, lang_col)
    return id_and_text(docs, id_col, text_col).mapInArrow(model.span_batches, _SPANS_DDL)


def keep_identified(docs: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows whose words' languages are known, with all their columns.

    The mean probability of each word's own best language must reach `least`, so texts that switch
    languages stay; texts without a letter go. Where no language was learned all rows stay.
    """
    model = fit(docs, id_col, text_col, lang_col)
    return docs.mapInArrow(model.kept_rows(text_col, least), docs.schema)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
