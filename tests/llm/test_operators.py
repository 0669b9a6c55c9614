"""Each operator against a brute-force form, and on nulls, empty and long texts, ties, repeated rows and empty tables."""

import json
import math
import random
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vigilo.llm import (decontaminate, lang_id, licenses, near_dup, packing, quality, scan, sharding, token_count, topk, transducer,
                        url_filter)

WORDS = "the of and to in alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma".split()
#: Extra columns named like the operators' own.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, token int, doc string, n double, chunk int, length int, shard int, rank int"


def texts():
    rng = random.Random(11)
    base = [" ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(60)) for _ in range(6)]
    near = []
    for b in base[:3]:
        for _ in range(4):
            w = b.split()
            for _ in range(rng.randint(1, 4)):
                w[rng.randrange(len(w))] = "changed%d" % rng.randint(0, 9)
            near.append(" ".join(w))
    return [*base, *near, base[0], base[0], "", None, " \n\t", "One two", "one  TWO", "123 456", "long " + "word " * 30000, "é ñ", "a"]


@pytest.fixture(scope="module")
def rows():
    return [(i * 3 + 1, t) for i, t in enumerate(texts())] + [(None, "no id here at all"), (1, texts()[0])]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", None, None, 1, "x", 0.5, 1, 1, 1, None) for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def test_near_duplicates(docs, rows, empty):
    got = near_dup.near_duplicates(docs, shingle=4).collect()
    sets = []
    for i, t in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", lower(t)) if x]
        sets.append((i, {tuple(w[k:k + 4]) for k in range(max(1, len(w) - 3))} if w else set()))
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, s in sets:
        for b, t in sets:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    expected = Counter((i, len(s), None if i is None else find(i), i is None or find(i) == i) for i, s in sets)
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == expected
    assert near_dup.near_duplicates(empty).count() == 0
    kept = near_dup.keep_one(docs, shingle=4)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted({find(i) for i, _ in sets if i is not None})


def test_large_near_group(spark):
    """A group larger than a block, whose members differ from each other more than from their source."""
    rng = random.Random(5)
    base = ["w%d" % i for i in range(120)]
    out = []
    for i in range(700):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(120)] = "x%d" % rng.randint(0, 10 ** 6)
        out.append((i, " ".join(w)))
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(spark.createDataFrame(out, "doc_id long, text string"), shingle=4).collect()}
    sets = [{tuple(t.split()[k:k + 4]) for k in range(117)} for _, t in out]
    root = list(range(700))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(700):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert got == {i: find(i) for i in range(700)}


def test_url_filter(spark):
    urls = ["http://Example.net/en/1?x=1", "https://a.b.EXAMPLE.com/de/2", "http://badexample.com/de/", "ftp://x.org/fr/1#f", "http://x.org/de/1",
            "no scheme", None, "", "http://", "http://net", "http://example.net/de/1", "http://host.net?x/y", "http://m.example.com/en/7"] * 2
    pages = spark.createDataFrame([(i, u, "h", "p", 1.0) for i, u in enumerate(urls)], "page_id long, url string, host string, suffix string, score double")
    got = {r.page_id: r for r in url_filter.judge(pages).collect()}
    for i, u in enumerate(urls):
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = lower(host)
        fit = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fit)[1:] if fit else (None, None)
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), u
        assert r.verdict == (verdict or ("block" if r.score >= url_filter.BLOCK_FROM else "allow"))
    assert url_filter.judge(pages.where("false")).count() == 0
    assert {r.verdict for r in url_filter.judge(pages.where("url = 'no scheme'")).collect()} == {"allow"}


def test_url_trees_learn(spark):
    bad = [("http://free-win%d.example.com/x%d" % (i, i * 7919), 1.0) for i in range(80)]
    good = [("http://site.example.com/en/page/%s" % ("abc" * (i % 5 + 1)), 0.0) for i in range(80)]
    model = url_filter.UrlModel(spark.createDataFrame(bad + good, "url string, blocked double"))
    host, path = url_filter.host_and_path(F.col("url"))
    new = spark.createDataFrame([("http://free-win999.example.com/x5512",), ("http://site.example.com/en/page/abcabc",)], "url string")
    scores = {r.url: r.score for r in model.score(new.withColumns({"host": host, "path": path})).collect()}
    assert scores["http://free-win999.example.com/x5512"] > 0.8 > 0.2 > scores["http://site.example.com/en/page/abcabc"]


def test_licenses(spark, docs, rows, empty):
    extra = ["Under the MIT License, under the mit license. CC-BY nc and cc by nc", "Apache License, Version 2.0!", "mit under the", "under the mit", "license",
             "This work is licensed under the GNU General Public License, version 3.", "é under the mit license", "under the mit licenseé",
             "x " * 500 + "All rights reserved. " + "y " * 500]
    table = docs.select("doc_id", "text", "n").unionByName(spark.createDataFrame([(1000 + i, t, 1.0) for i, t in enumerate(extra)], "doc_id long, text string, n double"))
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan_licenses(table).collect())
    expected = Counter()
    for i, t in [*rows, *((1000 + i, t) for i, t in enumerate(extra))]:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
        found = [(k, label) for text, label in licenses.PHRASES for k in range(len(w)) if w[k:k + len(text.split())] == text.split()]
        at = [k for k, _ in found]
        expected[i, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))] += 1
    assert got == expected
    labels = {r.doc_id: r.labels for r in licenses.scan_licenses(table.where("doc_id >= 1000")).collect()}
    assert labels[1005] == "gpl-3" and labels[1008] == "all-rights-reserved" and labels[1001] == "apache-2" and labels[1002] == ""
    assert licenses.scan_licenses(empty).count() == 0


def test_license_join_is_exact():
    """The filters find what counting every block against every template finds."""
    rng = random.Random(3)
    vocabulary = [w for text, _ in licenses.TEMPLATES for w in text.split()] + WORDS
    made = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 300))) for _ in range(60)] + [t for t, _ in licenses.TEMPLATES]
    part = next(scan.slices(iter([pa.record_batch({"doc_id": list(range(len(made))), "text": made})])))
    known = licenses.Templates(containment=0.4)
    w = licenses._words(part)
    number = known.numbers(w.h)
    known.order_by(np.bincount(number[number >= 0], minlength=len(known.vocabulary)))
    got = Counter((i, t, round(s, 9), lo) for i, t, s, lo, _ in known.block_matches(w, number))
    expected, labelled = Counter(), set()
    for i, text in enumerate(made):
        words = text.split()
        for t, (template, _) in enumerate(licenses.TEMPLATES):
            order = template.split()
            need, size = set(order), len(order)
            lo = 0
            while True:
                block = words[lo:lo + 2 * size]
                share = len(set(block) & need) / len(need)
                if len(set(block) & need) >= math.ceil(0.4 * len(need) - 1e-9):
                    expected[i, t, round(share, 9), lo] += 1
                    if common(order, block) >= math.ceil(0.4 * size - 1e-9):
                        labelled.add((i, t, lo))
                if lo + 2 * size >= len(words):
                    break
                lo += max(size // 2, 1)
    assert got == expected and len(got) > 20
    spans = list(known.labelled(w, number))
    blocks = {(i, t, lo): (lo, lo + n) for i, t, _, lo, n in known.block_matches(w, number)}
    assert len(spans) == len(labelled) > 10
    for i, t, _, first, last in spans:
        order, passage = licenses.TEMPLATES[t][0].split(), made[i].split()[first:last + 1]
        assert common(order, passage) >= known.in_order[t] and passage[0] in order and passage[-1] in order
        assert any((i, t) == key[:2] and lo <= first <= last < hi and key in labelled for key, (lo, hi) in blocks.items())


def common(a, b):
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = row
        row = [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(before[j + 1], row[j]))
    return row[-1]


def test_licenses_of_any_length_at_every_offset(spark, empty):
    rng = random.Random(8)
    for size in (3, 80, 120, 300):
        body = " ".join(f"w{k}" for k in range(size))
        known = licenses.Templates([(body, "own")], ())
        made = [" ".join(["fill"] * lead + body.split() + ["rest"] * rng.randint(0, 2 * size)) for lead in range(0, 2 * size + 3, max(1, size // 40))]
        w = licenses._words(_slice(made))
        found = list(known.labelled(w, known.numbers(w.h)))
        assert {f[0] for f in found} == set(range(len(made)))
        for i, _, share, first, last in found:
            lead = made[i].split().index("w0")
            assert share >= 0.9 and lead <= first <= last <= lead + size - 1
    words = body.split()
    edited = " ".join(x for k, x in enumerate(words) if k % 20)                  # one word in 20 is gone
    shuffled = " ".join(rng.sample(words, len(words)))
    table = spark.createDataFrame([(1, f"see {body}"), (2, edited), (3, shuffled), (4, None), (None, body), (1, f"see {body}")], "doc_id long, text string")
    got = licenses.license_spans(table, [(body, "own"), ("", "none")]).collect()
    assert Counter((r.doc_id, r.label, r.template) for r in got).keys() == {(1, "own", 0), (2, "own", 0), (None, "own", 0)}
    assert (1, 1, 300, 1.0) in {(r.doc_id, r.first_word, r.last_word, r.score) for r in got}
    assert licenses.license_spans(empty).count() == 0 and licenses.scan_licenses(table, ()).count() == 6


def test_words_of_a_license_in_another_order_are_not_one(spark):
    texts = ["released by the mit press under a new name while the press kept its license",
             "human rights are for all people and the best seats were reserved",
             "licensed for 4 cars under rule 0 by the cc of nc",
             "This file is released under the MIT license. All rights reserved."]
    got = {r.doc_id: r.labels for r in licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {0: "", 1: "", 2: "", 3: "all-rights-reserved,mit"}


def test_sharding(docs, rows, empty):
    got = sharding.shard(docs, 4).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len((t or "").encode()) + 8) for i, t in rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and set(by) <= set(range(4))
    assert sharding.shard(empty, 4).count() == 0


def test_slot_map_is_balanced_and_edited():
    rng = random.Random(2)
    weight = {s: rng.randint(100, 5000) for s in range(4096)}
    first = sharding.initial_map(4096, 24)
    second = sharding.rebalanced(first, weight, 24)
    load = Counter()
    for s, k in second.items():
        load[k] += weight[s]
    assert max(load.values()) - min(load.values()) <= 100
    assert sum(first[s] != second[s] for s in first) < 1000          # most slots stay where they were


def test_top_k(spark):
    rng = np.random.default_rng(4)
    vec = [(i, rng.normal(size=8).tolist(), "x") for i in range(700)]
    vec += [(i, vec[3][1], "x") for i in range(700, 900)]              # one very common vector
    vec += [(900, None, "x"), (901, [float("nan")] * 8, "x"), (902, [float("inf")] * 8, "x"), (903, [None] * 8, "x"), (950, [0.5, 0.25], "x"),
            (951, [1.0, -1.0], "x"), (100, vec[100][1], "x")]
    table = spark.createDataFrame(vec, "vec_id long, embedding array<double>, v string")
    got = Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(table).collect())
    good = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in vec if v and all(x is not None and math.isfinite(x) for x in v)]
    expected = Counter()
    for q, v in {(i, tuple(v)) for i, v in good if i % 50 == 0}:
        found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q and len(w) == len(v))[:5]
        for k, (s, i) in enumerate(found, 1):
            expected[q, k, i, -s] += 1
    assert got == expected
    assert topk.top_k(table.where("false")).count() == 0


def test_kd_tree_prunes_exactly():
    rng = np.random.default_rng(8)
    points, ids = rng.integers(-50, 50, (3000, 4)), rng.permutation(3000)
    tree = topk.KdTree(ids, points)
    queries = rng.integers(-50, 50, (30, 4))
    bound = tree.bounds(queries)
    for i, q in enumerate(queries):
        best = sorted(((int(s), -int(m)) for s, m in zip(points @ q, ids)), reverse=True)[:5]
        assert sorted(tree.search(-1, q, bound[i], 5, None), reverse=True) == best
        assert sorted(tree.search(-1, q, bound[i], 5, best[-1][0]), reverse=True) == best


def test_top_k_of_repeated_ids(spark):
    """One leaf in which the query's own id is repeated at the top."""
    rng = random.Random(7)
    for repeats in (2, 6, 40):
        vec = [(50, [9.0, 9.0])] * repeats + [(i, [rng.random(), rng.random()]) for i in range(1, 24)]
        got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(spark.createDataFrame(vec, "vec_id long, embedding array<double>")).collect()]
        scored = sorted((-sum(math.floor(256 * x) * 9 * 256 for x in v), i) for i, v in vec if i != 50)[:5]
        assert sorted(got) == [(50, k, i, -s) for k, (s, i) in enumerate(scored, 1)]


def test_language_held_out(spark, empty, docs):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = lang_id.identify(table).join(table.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got) > 0
    edge = spark.createDataFrame([(5, None, "en"), (6, "", "en"), (7, "12 34 × !", "de"), (None, "the and of", None)], "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in lang_id.identify(table.select("doc_id", "text", "lang").unionByName(edge.withColumn("doc_id", F.col("doc_id") + 10 ** 6))).collect()}
    assert [out[10 ** 6 + i].lang_pred for i in (5, 6, 7)] == ["und"] * 3 and out[10 ** 6 + 5].score == 0
    assert lang_id.identify(empty).count() == 0
    assert {r.lang_pred for r in lang_id.identify(docs).collect()} <= {"en", "und"}
    kept = lang_id.keep_identified(docs)
    assert kept.columns == docs.columns and kept.where("text is null or trim(text) = ''").count() == 0


def test_mixed_languages_are_kept(spark):
    """Texts that switch languages stay, unsure words go, and where nothing was learned all rows stay."""
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang")
    words = defaultdict(list)
    for r in table.where("lang is not null and length(text) > 400").orderBy("doc_id").collect():
        words[r.lang] += r.text.split()
    a, b, c = sorted(words)[:3]
    mixed = [(10 ** 6, [(a, 40), (b, 35), (c, 25)]), (10 ** 6 + 1, [(a, 60), (b, 60)]), (10 ** 6 + 2, [(a, 34), (b, 33), (c, 33)]),
             (10 ** 6 + 3, [(x, 10) for x in (a, b, c) * 4]), (10 ** 6 + 4, [(c, 49), (a, 51)])]
    rows = [(i, " ".join(" ".join(words[lang][200:200 + n]) for lang, n in parts), None) for i, parts in mixed]
    rows += [(10 ** 6 + 9, "12 34 !", None)]
    both = table.unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {r.score < 0.5 for r in lang_id.identify(both).where("doc_id in (1000000, 1000002, 1000003)").collect()} == {True}
    kept = {r.doc_id for r in lang_id.keep_identified(both).where("doc_id >= 1000000").collect()}
    assert kept == {i for i, _ in mixed}
    unlabelled = both.withColumn("lang", F.lit(None).cast("string"))
    assert lang_id.keep_identified(unlabelled).count() == both.count()
    held_out = both.withColumn("lang", F.when(lang_id._held_out(F.col("doc_id")), F.col("lang")))
    assert lang_id.keep_identified(held_out).count() == both.count()
    unsure = lang_id.LangModel(list("abcd"), np.zeros((4, 4 << lang_id.HASH_BITS), np.float32), np.zeros(4), np.zeros((4, 4)))
    batch = pa.record_batch({"doc_id": [1], "text": ["some words of no clear language"]})
    assert sum(x.num_rows for x in unsure.kept_rows("text", 0.5)(iter([batch]))) == 0


def test_seeds_are_the_same_in_a_corpus_many_times_over():
    rng = random.Random(6)
    items = [" ".join(rng.choice(WORDS) for _ in range(40)) for _ in range(12)]
    seeds = []
    for times in (1, 200, 10 ** 6):
        block = decontaminate.Items(list(range(12)), items)
        counts = np.array([rng_count % 90 for rng_count in range(len(block.known))]) * times
        block.pick_seeds(counts)
        seeds.append(block.seeds.tolist())
    assert seeds[0] == seeds[1] == seeds[2] and seeds[0]


def test_alignment_does_not_depend_on_the_batches(monkeypatch):
    rng = np.random.default_rng(4)
    items = [rng.integers(0, 9, rng.integers(1, 30)).astype(np.uint64) for _ in range(50)]
    windows = [rng.integers(0, 9, rng.integers(1, 400)).astype(np.uint64) for _ in range(50)]
    whole = decontaminate.align(items, windows)
    monkeypatch.setattr(decontaminate, "_CELLS", 300)
    assert all((x == y).all() for x, y in zip(whole, decontaminate.align(items, windows)))


def _slice(texts):
    rows = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    return next(scan.slices(iter([rows])))


def _random_model(labels=4, seed=3):
    rng = np.random.default_rng(seed)
    return lang_id.LangModel(list("abcdef"[:labels]), rng.normal(0, 0.6, (labels, 4 << lang_id.HASH_BITS)).astype(np.float32),
                             rng.normal(0, 1, labels), rng.normal(0, 1.5, (labels, labels)))


def test_a_text_is_one_chain_whatever_its_length():
    rng, model = random.Random(2), _random_model()
    texts = [" ".join(rng.choice(WORDS) for _ in range(n)) for n in (10_000, 1, 63, 64, 65, 128, 129, 500)] + ["", "7 8"]
    part = _slice(texts)
    best, score, sure = model.predict(part)
    w, label, share = model.word_labels(part)
    emitted = lang_id._word_scores(model.weights, part.buf, w).T.astype(float)
    for i in range(len(texts)):
        a, b = w.first[i], w.first[i + 1]
        if a == b:
            assert best[i] == -1 and score[i] == 0
            continue
        gamma = lang_id.forward_backward(emitted[None, a:b], np.array([b - a]), model.start, model.step)[0][0]
        mean = gamma.mean(0)
        assert best[i] == mean.argmax() and score[i] == pytest.approx(mean.max(), abs=1e-9)
        assert sure[i] == pytest.approx(gamma.max(1).mean(), abs=1e-9)
        assert share[a:b] == pytest.approx(gamma.max(1), abs=1e-9)
        assert (label[a:b] == gamma.argmax(1)).all()


def test_language_spans(spark, docs, empty):
    english, german = "the house and the garden were very quiet that evening", "das haus und der garten waren an jenem abend sehr still"
    learn = [(i, [english, german][i % 2] + f" {chr(97 + i % 26)}", ["en", "de"][i % 2]) for i in range(80)]
    mixed = [(1000, f"{english} {german}", None), (1001, None, None), (1002, " 12 ", None), (1000, german, None)]
    table = spark.createDataFrame(learn + mixed, "doc_id long, text string, lang string")
    got = [r for r in lang_id.language_spans(table).collect() if r.doc_id >= 1000]
    assert sorted((r.doc_id, r.first_word, r.last_word, r.lang) for r in got) == [(1000, 0, 9, "en"), (1000, 0, 10, "de"), (1000, 10, 20, "de")]
    assert all(0.5 < r.score <= 1 for r in got)
    assert lang_id.language_spans(empty).count() == 0
    none = lang_id.language_spans(table.withColumn("lang", F.lit(None).cast("string"))).where("doc_id = 1000").collect()
    assert {(r.lang, r.score) for r in none} == {("und", 0.0)}


def test_training_is_bounded_for_unspaced_texts_and_repeated_ids(spark):
    long = "\u6f22\u5b57" * 100_000
    table = spark.createDataFrame([(1, long, "zh")] * 5 + [(i, "plain words in a row", "en") for i in range(3, 9)], "doc_id long, text string, lang string")
    model = lang_id.fit(table)
    assert model.langs == ["en", "zh"]
    (piece,) = {s for b in lang_id._snippets(iter([pa.record_batch({"lang": ["zh"], "text": [long]})])) for s in b.column(1).to_pylist()}
    assert len(piece.encode()) <= lang_id.SNIPPET_BYTES and long.startswith(piece)
    best, _, _ = model.predict(_slice([long, "plain words"]))
    assert [model.langs[k] for k in best] == ["zh", "en"]


def test_forward_backward_sums_over_paths():
    rng = np.random.default_rng(1)
    score, start, step = rng.normal(size=(1, 4, 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    gamma, moves = lang_id.forward_backward(score, np.array([4]), start, step)
    total, by, trans = 0, np.zeros((4, 3)), np.zeros((3, 3))
    for path in np.ndindex(3, 3, 3, 3):
        p = math.exp(start[path[0]] + sum(score[0, t, k] for t, k in enumerate(path)) + sum(step[a, b] for a, b in zip(path, path[1:])))
        total += p
        for t, k in enumerate(path):
            by[t, k] += p
        for a, b in zip(path, path[1:]):
            trans[a, b] += p
    assert np.allclose(gamma[0], by / total) and np.allclose(moves, trans / total)


def odd_texts():
    rng = random.Random(3)
    parts = [*"ab tT'sredvlm  \n\t!?.19é中  ñ'’́\x1c\x85<", "<|endoftext|>", " <|endoftext|>", "'re", "'ll", " b", "  "]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + ["", " ", "a" * 5000, "\n\n"]


def test_token_counts(spark, docs, rows, empty):
    path = transducer.default_path()
    tokenizer = transducer.open_tokenizer(path)[0]
    made = odd_texts()
    table = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_count.token_counts(table).collect()}
    assert got == {i: (len(t.encode()), len(e.ids)) for i, (t, e) in enumerate(zip(made, tokenizer.encode_batch(made, add_special_tokens=False)))}
    got = Counter((r.doc_id, r.n_tokens, r.over_limit) for r in token_count.token_counts(docs, path).collect())
    n = [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    assert got == Counter((i, k, k > 1024) for (i, _), k in zip(rows, n))
    assert token_count.token_counts(empty).count() == 0


def test_packing(spark, docs, rows, empty):
    import zlib

    tokenizer = transducer.open_tokenizer(transducer.default_path())[0]
    made = [(1000 + i, t) for i, t in enumerate(odd_texts()[::7])]
    table = docs.select("doc_id", "text", "length", "chunk").unionByName(spark.createDataFrame([(i, t, 1, 1) for i, t in made], "doc_id long, text string, length int, chunk int"))
    got = packing.pack(table).collect()
    expected = Counter()
    for i, t in [*rows, *made]:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        head = len(ids) if len(ids) <= 2048 else len(ids) % 2048 or 2048
        bounds = [0, *range(head, len(ids) + 1, 2048)]
        for p, (a, b) in enumerate(zip(bounds, bounds[1:])):
            expected[i, p, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    used = defaultdict(list)
    for r in got:
        used[r.sequence_id].append((r.offset, r.length))
    for x in used.values():
        x.sort()
        assert x[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(x, x[1:])) and x[-1][0] + x[-1][1] <= 2048
    assert len(used) <= 1.02 * sum(r.length for r in got) / 2048 + 1
    assert packing.pack(empty).count() == 0


def test_packed_sequences_hold_their_ids(spark, docs, rows):
    """The rows of a sequence spell it, and the checksum is theirs."""
    import zlib

    tokenizer = transducer.open_tokenizer(transducer.default_path())[0]
    got = packing.pack(docs).collect()
    sequences, pieces = defaultdict(dict), defaultdict(list)
    for r in got:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        sequences[r.sequence_id].update(zip(range(r.offset, r.offset + r.length), r.ids))
        pieces[r.doc_id].append((r.start, r.ids))
    assert all(sorted(x) == list(range(len(x))) and len(x) <= 2048 for x in sequences.values())
    assert sum(len(x) for x in sequences.values()) == sum(r.length for r in got)
    for i, t in rows:
        if sum(j == i for j, _ in rows) == 1:
            assert [x for _, ids in sorted(pieces[i]) for x in ids] == [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
    small = packing.op7(spark, SF_SMALL)
    assert small.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_library_is_asked_in_blocks(monkeypatch):
    """New pre-tokens go to the library thousands at a time; special strings, in blocks too, stay one id."""
    made = odd_texts()
    path = transducer.default_path()
    asked = packing.UnitIds(path)
    tokenizer, opened = asked.tokenizer, []

    class Counting:
        @property
        def model(self):
            opened.append(1)
            return tokenizer.model

    asked.tokenizer = Counting()
    monkeypatch.setattr(packing, "ASKED", 7, raising=False)
    batch = pa.record_batch({"doc_id": list(range(len(made))), "text": made})
    got, parts = [], 0
    for part in scan.slices(iter([batch])):
        parts += 1
        ids, first = asked.of(part)
        got += [ids[a:b].tolist() for a, b in zip(first, first[1:])]
    assert got == [[*e.ids, 0] for e in tokenizer.encode_batch(made, add_special_tokens=False)]
    assert 1 <= len(opened) <= parts


def test_staged_ids_are_bytes(tmp_path):
    """Pieces are staged with two bytes an id, which sort as the ids do; larger ids take four."""
    path = transducer.default_path()
    tokenizer = transducer.open_tokenizer(path)[0]
    text = "Packed " + " ".join(WORDS) * 200
    ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
    batch = pa.record_batch({"doc_id": pa.array([5, None], pa.int64()), "text": [text, None]})
    got = [r for b in packing._pieces(path, 300)(iter([batch])) for r in b.to_pylist()]
    assert all(isinstance(r["ids"], bytes) and len(r["ids"]) == 2 * r["length"] for r in got)
    assert [x for r in got for x in np.frombuffer(r["ids"], ">u2").tolist()] == [*ids, 0]
    spelled = [(r["ids"], np.frombuffer(r["ids"], ">u2").tolist()) for r in got]
    assert [x for _, x in sorted(spelled)] == sorted(x for _, x in spelled)

    spec = json.load(open(path, encoding="utf-8"))
    spec["model"]["vocab"] = {k: i + 70_000 for k, i in spec["model"]["vocab"].items()}
    for t in spec["added_tokens"]:
        t["id"] += 70_000
    wide = tmp_path / "wide.json"
    wide.write_text(json.dumps(spec), encoding="utf-8")
    got = [r for b in packing._pieces(str(wide), 300)(iter([batch])) for r in b.to_pylist()]
    assert all(len(r["ids"]) == 4 * r["length"] for r in got)
    rows = pa.Table.from_pylist([{**r, "sequence_id": 0, "offset": 0} for r in got]).to_batches()
    packed = [r for b in packing._with_checksums(iter(rows)) for r in b.to_pylist()]
    assert [x for r in packed for x in r["ids"]] == [*(i + 70_000 for i in ids[:-1]), 0, 0]
    assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in packed)


def test_kept_with_colliding_keys():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 50, 4000).astype(np.uint64) << np.uint64(58) | rng.integers(0, 1 << 40, 4000).astype(np.uint64))
    kept = transducer.Kept(4)
    values = rng.integers(0, 9, len(keys))
    for i in range(0, len(keys), 700):
        kept.put(keys[i: i + 700], values[i: i + 700])
    assert kept.n == len(keys) and (kept.get(keys) == values).all() and (kept.get(keys + np.uint64(1 << 50)) == -1).all()


def test_plan_places_every_piece():
    rng = random.Random(1)
    counts = Counter(rng.choice((rng.randint(1, 2048), 700, 2048)) for _ in range(4000))
    planned = packing.plan(dict(counts))
    placed = Counter()
    for lengths, times in planned:
        assert sum(lengths) <= 2048 and times > 0
        for v in lengths:
            placed[v] += times
    gaps, bins = [], 0                                                # best-fit decreasing, one piece at a time
    for v in sorted(counts.elements(), reverse=True):
        i = bisect_left(gaps, v)
        bins += i == len(gaps)
        insort(gaps, (gaps.pop(i) if i < len(gaps) else 2048) - v)
    assert placed == counts and sum(t for _, t in planned) <= 1.01 * bins


def test_quality(spark, docs, empty):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.resample(table, labels).join(labels, "doc_id").collect()
    good, bad = [r.kept for r in got if r.quality == 1], [r.kept for r in got if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.6 * len(bad)
    assert quality.resample(docs, labels.where("false")).where("not kept").count() == 0
    odd = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (4, None), (7, 1)], "doc_id long, quality int")
    assert quality.resample(docs, odd).count() == docs.count()
    assert quality.resample(empty, labels).count() == 0
    assert quality.keep_good(docs, labels.where("false")).columns == docs.columns


def test_top_keys_are_exact(spark):
    rng = random.Random(9)
    keys = [rng.randint(-10 ** 9, 10 ** 9) for _ in range(500)] + [77] * 20
    table = spark.createDataFrame([(k,) for k in keys], "key long")
    for k in (1, 250, 300, 520):
        assert quality._least_key(table, k) == sorted(keys, reverse=True)[k - 1]


def brute_align(item, window):
    h, best = [[0] * (len(window) + 1) for _ in range(len(item) + 1)], 0
    for i, a in enumerate(item, 1):
        for j, b in enumerate(window, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a == b else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment():
    rng = np.random.default_rng(6)
    items = [rng.integers(0, 6, rng.integers(1, 20)).astype(np.uint64) for _ in range(300)]
    windows = [rng.integers(0, 6, rng.integers(1, 40)).astype(np.uint64) for _ in range(300)]
    assert decontaminate.align(items, windows)[0].tolist() == [brute_align(a, b) for a, b in zip(items, windows)]


def test_leaks(spark, docs, empty):
    rng = random.Random(12)
    pool = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)] + WORDS * 8
    make = lambda n: [rng.choice(pool) for _ in range(n)]
    items = [make(rng.randint(15, 50)) for _ in range(12)]
    made, truth = [], set()
    for i in range(120):
        words = make(200)
        if i < 36:
            item = list(items[i % 12])
            if i >= 12:                                              # edited: some words changed, one dropped, one added
                for _ in range(len(item) // 8):
                    item[rng.randrange(len(item))] = rng.choice(pool)
                del item[len(item) // 2]
                item.insert(3, "added")
            words[50:50] = item
            truth.add((i, i % 12))
        made.append((i, " ".join(words).upper() if i % 2 else ", ".join(words)))
    bench = spark.createDataFrame([(i, " ".join(w), "x") for i, w in enumerate(items)] + [(98, None, "x"), (99, "", "x"), (None, "two words", "x")],
                                  "item_id long, text string, score string")
    table = spark.createDataFrame(made, "doc_id long, text string").withColumn("score", F.lit(1))
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(table, bench).collect()} == truth
    assert sorted(r.doc_id for r in decontaminate.drop_leaked(table, bench).collect()) == list(range(36, 120))
    assert decontaminate.find_leaks(docs, bench).count() == 0
    assert decontaminate.find_leaks(empty, bench).count() == 0 and decontaminate.find_leaks(docs, bench.where("false")).count() == 0
    assert decontaminate.drop_leaked(docs, bench).columns == docs.columns


def test_leaks_of_long_items(spark):
    """A run of a long item counts by its own length, also where it is the item's most common part."""
    rng = random.Random(21)
    make = lambda n: ["w%d" % rng.randrange(4000) for _ in range(n)]
    item = make(400)
    runs = [(0, 150), (250, 400), (120, 151), (37, 67), (0, 10)]
    made = [(i, [*make(80), *item[a:b], *make(80)]) for i, (a, b) in enumerate(runs)]
    edited = item[100:250]
    for k in range(10, 150, 15):
        edited[k] = "edited"
    made += [(10, [*make(50), *edited, *make(50)]), (11, make(600))]
    made += [(100 + i, [*make(20), *item[330:370], *make(20)]) for i in range(150)]          # 40 words that are everywhere
    made += [(1000 + i, [*make(20), *item[a:a + 20], *make(20)]) for i, a in enumerate([*range(0, 300, 10)] * 2)]  # too short to count
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in made], "doc_id long, text string")
    bench = spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: r.score for r in decontaminate.find_leaks(table, bench).collect()}
    assert set(got) == {0, 1, 2, 3, 10, *range(100, 250)}
    assert 0.375 <= got[0] < 0.39 and 0.0775 <= got[2] < 0.1
    assert {r.doc_id for r in decontaminate.drop_leaked(table, bench).collect()} == {i for i, _ in made} - set(got)
