"""Operators 11 to 13 against brute force, and on nulls, empty and long texts, ties, repeated rows and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from vigilo.llm import align, imatch, variants

SCHEMA = "doc_id long, text string, lang string, n long, word string, h long, uid long, kind string, pid int, whole string, pairs string"


def text_rows():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(3, 8))) for _ in range(160)]
    out = []
    for i in range(90):
        body = " ".join(rng.choice(words) for _ in range(rng.randint(1, 120)))
        out.append((3 * i - 20, body.title() if i % 7 == 0 else body))
    out += [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "One two  three   "), (1004, "   lead<|endoftext|>tail <s> </s>"),
            (1005, "ﬁne ² 日本語 ☃ 𝔘 é▁x"), (1006, "a"), (1007, "xyzzy " * 40000), (1008, "tab\tand\r\nlines\n\n\nend\n"),
            (1009, "naïve Ünïcode ÀÉÎ don't we'll 12345 !!!"), (1009, out[0][1]), (1010, out[0][1]), (None, "no id at all"), (1011, "\x00 nul"),
            (1012, "é" * 3000)]
    return out


@pytest.fixture(scope="module")
def rows():
    return text_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1, "w", 2, 3, "k", 4, "x", "p") for i, t in rows], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ------------------------------------------------------------------ 11

def brute_groups(count: dict) -> list:
    near = defaultdict(set)
    holes = defaultdict(set)
    for w in count:
        for i in range(len(w)):
            holes[w[:i], w[i + 1:]].add(w)
            shorter = w[:i] + w[i + 1:]
            if shorter in count:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in count:
        if near[w]:
            m, best = min((-count[x], x) for x in near[w])
            if -m >= 2 * count[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted((w, form.get(w, ""), root(w), n, len(near[w]), count[form[w]] if w in form else -1) for w, n in count.items())


def grouped(df) -> list:
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in df.collect())


def test_position_index_finds_exactly_one_edit():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(300)})
    index = variants.PositionIndex(words)
    near = {w: {x for x in words if x != w and (
        len(x) == len(w) and sum(a != b for a, b in zip(x, w)) == 1
        or any(w[:i] + w[i + 1:] == x for i in range(len(w))) or any(x[:i] + x[i + 1:] == w for i in range(len(x))))} for w in words}
    for w in words:
        assert {words[i] for i in variants._bits(index.one_edit(w))} == near[w]


@pytest.mark.parametrize("block", [variants.BLOCK, 40, 4])
def test_variant_groups(spark, block):
    """Few letters: nearly every word has near ones; small blocks force posts at every level."""
    rng = random.Random(3)
    count = {w: rng.randint(1, 40) for w in {"".join(rng.choice("abé") for _ in range(rng.randint(1, 11))) for _ in range(2500)}}
    got = grouped(variants.group_variants(spark.createDataFrame(sorted(count.items()), "word string, n long"), block=block))
    assert got == brute_groups(count)


def test_words_of_texts(docs, rows, empty):
    count = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                count[run] += 1
    kept = {w: n for w, n in count.items() if n >= 3}
    words = variants.words(docs)
    assert {r.word: r.n for r in words.collect()} == kept and len(kept) > 50
    assert grouped(variants.group_variants(words)) == brute_groups(kept)
    assert variants.group_variants(variants.words(empty)).count() == 0


# ------------------------------------------------------------------ 12

def test_edit_likeness(docs, rows, empty):
    got = imatch.edit_likeness(docs).collect()
    assert len(got) == len(rows)
    own, by_id = {}, defaultdict(list)
    for r in got:
        by_id[r.doc_id].append(r)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for k, (i, t) in enumerate(order):
        if i == 1009 or order[(k + 1) % len(order)][0] == 1009:        # two rows of one id: either may come first
            continue
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        q = len(t) // 4
        edited = t[:len(t) - q] + after[:q]
        (r,) = by_id[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if edited == t:
            assert r.near_edited == 1 and r.fingerprint == r.edited_fingerprint
        assert own.setdefault(t, r.fingerprint) == r.fingerprint
    long = [r for r in got if r.n_chars > 300 and r.doc_id is not None and r.doc_id < 1000]
    assert sum(r.near_edited > r.near_next for r in long) > 0.9 * len(long)
    joined = imatch.edit_likeness(docs, most_sent=0).collect()
    assert sorted(map(repr, joined)) == sorted(map(repr, got))
    assert imatch.edit_likeness(empty).count() == 0 and imatch.fingerprints(empty).count() == 0
    sent, held = ({(r.doc_id, r.fingerprint) for r in imatch.fingerprints(docs, most_sent=m).collect()} for m in (10 ** 6, 0))
    assert sent == held == {(r.doc_id, r.fingerprint) for r in got}


def test_single_document_follows_itself(spark):
    (r,) = imatch.edit_likeness(spark.createDataFrame([(1, "abcd efgh ijkl")], "doc_id long, text string")).collect()
    assert r.edited_sha256 == hashlib.sha256(b"abcd efgh iabc").hexdigest() and r.near_next == 1


def test_lexicon_is_the_band(docs, rows):
    count = Counter()
    for _, t in rows:
        count.update(set(re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").translate({c: c + 32 for c in range(65, 91)}).encode())))
    n = len(rows)
    band = [w for w, c in count.items() if n ** 0.1 <= c <= n ** 0.85]
    assert imatch.lexicon(docs).count() == len(band) > 50


# ------------------------------------------------------------------ 13

def test_align_is_the_common_ends():
    rng = random.Random(1)
    for _ in range(2000):
        n = rng.randint(1, 90)
        a = sorted({*rng.sample(range(1, n + 1), rng.randint(0, n)), n})
        b = sorted({*(x for x in a if rng.random() < 0.9), *rng.sample(range(1, n + 1), rng.randint(0, n // 6)), n})
        last_a, last_b = align.align(np.array(a), np.array(b))
        common = sorted({*a} & {*b})
        assert last_a.tolist() == [a.index(c) for c in common] and last_b.tolist() == [b.index(c) for c in common]
    assert [len(x) for x in align.align(np.zeros(0), np.zeros(0))] == [0, 0]


def test_linked_documents(docs, rows, empty):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    from vigilo.llm.transducer import byte_symbols

    one = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    symbols = byte_symbols()

    def piece(i):
        return bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode()

    held, expected = Counter(), []
    for i, t in rows:
        a = one.encode(" " + t, add_special_tokens=False).ids if t else []
        b = two.encode(t) if t else []
        spelled_a, spelled_b = [bytes(symbols[c] for c in one.id_to_token(x)) for x in a], [piece(x) for x in b]
        if not t or b"".join(spelled_a) != (" " + t).encode() or b"".join(spelled_b) != (" " + t).encode():
            expected.append((i, 0, 0, 0, 0, "", []))
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in s]).tolist() for s in (spelled_a, spelled_b))
        groups, links, x, y = [], [], 0, 0
        for c in sorted({*ends_a} & {*ends_b}):
            nx, ny = ends_a.index(c, x) + 1, ends_b.index(c, y) + 1
            groups.append(",".join(map(str, a[x:nx])) + "|" + ",".join(map(str, b[y:ny])))
            for p in range(x, nx):
                for q in range(y, ny):
                    if max(ends_a[p] - len(spelled_a[p]), ends_b[q] - len(spelled_b[q])) < min(ends_a[p], ends_b[q]):
                        links.append((a[p], b[q]))
            x, y = nx, ny
        held.update(set(links))
        expected.append((i, len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest(), links))
    best = Counter()
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    full = Counter((*e[:6], sum(held[p] == best[p[0]] for p in e[6]), sum(held[p] for p in e[6])) for e in expected)
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")
    assert Counter(tuple(r) for r in align.linked_documents(docs).select(*names).collect()) == full
    assert Counter(tuple(r) for r in align.linked_documents(docs, most_sent=0).select(*names).collect()) == full
    assert sum(e[5] == "" for e in expected) >= 3 and sum(e[5] != "" for e in expected) > 90
    assert align.linked_documents(empty).count() == 0
    spelled = align.alignments(docs).select("groups", "groups_sha256").collect()
    assert all(r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "") for r in spelled)
