"""Operator 13: against DuckDB SQL and brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from brute import same
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import collocations as co

SCHEMA = "doc_id long, text string, lang string, source string, n long, word string, a long, piece string, score string, bucket int, id long, rank int"


def full(rows):
    return [(k, t, g, "s", 1, "x", 2, "x", "x", 3, 4, 5) for k, (t, g) in enumerate(rows)]


def pieces(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n\x0b\x0c\r]", low)]


def gram_counts(rows):
    f = defaultdict(Counter)
    for text, lang in rows:
        for p in pieces(text):
            for k in (1, 2, 3):
                f[lang or "und" if lang is None else lang].update(tuple(p[i:i + k]) for i in range(len(p) - k + 1))
    return f


def brute(rows, least=10, top=2000):
    out = []
    for lang, f in gram_counts(rows).items():
        n = sum(v for g, v in f.items() if len(g) == 1)
        cand = {g: v for g, v in f.items() if len(g) >= 2 and v >= least}
        covered = {part for g, v in cand.items() if len(g) == 3 for part in (g[:2], g[1:]) if 100 * v >= 50 * f[part]}
        found = []
        for g, a in cand.items():
            if g in covered:
                continue
            s, k = min((1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            found.append((-s, -a, " ".join(g).encode(), a, f[g[:k]], f[g[k:]], n, s))
        out += [(lang, i + 1, x[2].decode(), *x[3:]) for i, x in enumerate(sorted(found)[:top])]
    return sorted(out)


def corpus(seed=1, docs=150):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(30)]
    chain = "Alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(None, "en"), ("", None), ("only", "xx"), ("a b " * 40, None), ("A B\x0bc, d", "und"), ("Ünï Ünï Ünï ünï " * 12, "é"), ("ẞ İ ẞ İ ẞ İ\tẞ İ. " * 6, "é"), ("\x00 \x01 " * 20, "en")]
    for _ in range(docs):
        words = []
        for _ in range(rng.randint(1, 40)):
            r = rng.random()
            words += ["the"] if r < 0.3 else ["of", "the"] if r < 0.4 else [rng.choice(vocab)] if r < 0.9 else chain.split()
            words[-1] += rng.choice(["", "", "", "", ".", ",", "\n"])
        rows.append((" ".join(words), rng.choice(["en", "en", "en", "de"])))
    return rows


def rows_of(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.mark.parametrize("size", [{}, {"bucket_bytes": 700, "batch_tokens": 50}, {"bucket_bytes": 300, "batch_tokens": 97, "fanout": 4}], ids=["one bucket", "buckets", "three rounds"])
def test_against_brute_force(spark, oracle, size):
    rows = corpus()
    docs = spark.createDataFrame(full(rows), SCHEMA).repartition(3)
    got = co.best(co.phrases(co.counted(docs, **size)))
    assert rows_of(got) == brute(rows)
    if not size:
        same(got.toPandas(), oracle(co.OP13_SQL, documents=docs.toPandas()))
        few = co.best(co.phrases(co.counted(docs, min_count=2)), top=3)
        assert rows_of(few) == brute(rows, least=2, top=3)
        assert co.best(co.phrases(co.counted(docs.limit(0)))).count() == 0


def test_flows_are_exact_counts(spark):
    rows = corpus(7, 60)
    t = co.counted(spark.createDataFrame(full(rows), SCHEMA), min_count=3, bucket_bytes=500, batch_tokens=60)
    word = {r.id: (r.lang, r.word) for r in t["words"].collect()}
    f = gram_counts(rows)
    assert {(*word[r.id], r.n) for r in t["words"].collect()} == {(g, w[0], n) for g, c in f.items() for w, n in c.items() if len(w) == 1 and n >= 3}
    assert {(word[r.a], word[r.b], r.n) for r in t["nodes"].collect()} == {((g, w[0]), (g, w[1]), n) for g, c in f.items() for w, n in c.items() if len(w) == 2 and n >= 3}
    assert {(word[r.a], word[r.b], word[r.c], r.n) for r in t["edges"].collect()} == {(*((g, x) for x in w), n) for g, c in f.items() for w, n in c.items() if len(w) == 3 and n >= 3}
    assert {(r.lang, r.n) for r in t["totals"].collect()} == {(g, sum(n for w, n in c.items() if len(w) == 1)) for g, c in f.items() if c}


def test_unary_paths_become_one_row(spark, monkeypatch):
    text = " ".join(f"p{k}" for k in range(40))
    rows = [(text, "en")] * 12 + [("x p5 p6 y", "en")] * 11
    t = co.counted(spark.createDataFrame(full(rows), SCHEMA))
    paths, junctions = co.compacted(t["nodes"], t["edges"])
    word = {r.id: r.word for r in t["words"].collect()}
    lines = sorted([word[p.steps[0].a], word[p.steps[0].b], *(word[s.c] for s in p.steps)] for p in paths.collect())
    one = text.split()
    # (p5 p6) has two edges on either side, so four paths meet there
    assert lines == sorted([one[:7], one[5:], ["x", "p5", "p6"], ["p5", "p6", "y"]])
    ends = {(word[r.a], word[r.b]) for r in junctions.collect()}
    assert ends == {("p0", "p1"), ("p5", "p6"), ("p38", "p39"), ("x", "p5"), ("p6", "y")}
    monkeypatch.setattr(co, "BLOCK", 4)
    cut, _ = co.compacted(t["nodes"], t["edges"])
    assert cut.count() == 2 + 2 + 9 and max(len(p.steps) for p in cut.collect()) == 4


def test_scores_beyond_64_bits(spark):
    a, left, right = 3_000_000_000_001, 3_000_000_000_007, 9_000_000_000_011
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert df.select(co.score(df.a, df.l, df.r)).first()[0] == 1_000_000 * a * a // (left * right)


ALPHABET = st.sampled_from(["a", "B", "ab", " ", " ", "\t", ".", "\n", "é", "ccc"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(ALPHABET, max_size=30).map("".join), st.sampled_from(["en", "de", None])), max_size=8), st.integers(1, 12), st.integers(1, 30))
def test_batches_count_grams_for_any_slices(rows, limit, size):
    """Slices, long texts in parts and flushes cut anywhere give the same counts."""
    deal = co.Deal(3, [], [])
    batch = pa.RecordBatch.from_arrays([pa.array([g for _, g in rows], pa.string()), pa.array([t for t, _ in rows], pa.string())], ["lang", "text"])
    sent = [m for out in co._count(deal, 1, size, limit)([batch]) for m in out.to_pylist()]
    spelled, grams, total = {}, Counter(), Counter()
    for m in sent:
        (h1, h2, h3, c), (ids, lang, n, raw), t = co.opened(m["data"])
        assert (np.diff(h1) >= 0).all()
        at = 0
        for i, g, k in zip(ids.tolist(), lang.tolist(), n.tolist(), strict=True):
            spelled[i] = m["langs"][g], raw[at:at + k].tobytes().decode()
            at += k
        for key in zip(h1.tolist(), h2.tolist(), h3.tolist(), c.tolist(), strict=True):
            grams[key[:3]] += key[3]
        total.update(dict(zip(m["langs"], t.tolist(), strict=False)))
    want, words = Counter(), Counter()
    for text, lang in rows:
        g = "und" if lang is None else lang
        for p in pieces(text):
            words[g] += len(p)
            for i in range(len(p)):
                want[tuple((g, x) for x in p[i:i + 3])] += 1
    assert Counter({tuple(spelled[x] for x in k if x): v for k, v in grams.items()}) == want
    assert +total == +words


def test_long_words_and_texts_in_parts():
    """A word longer than a slice is one word, numbered alike wherever it stands."""
    big = "x" * 300_000
    text = f"a {big} b {big}. {'c d ' * 2000}"
    data = np.frombuffer(text.encode(), np.uint8)
    parts = list(co.parts_of(data, 1000))
    assert parts[0][0] == 0 and parts[-1][1] == len(data) and all(x[1] == y[0] for x, y in zip(parts, parts[1:], strict=False))
    b = co.Batch()
    for a, z in parts:
        b.add(data[a:z], np.array([0, z - a]), ["en"], a > 0)
    whole = co.Batch()
    whole.add(data, np.array([0, len(data)]), ["en"], False)
    (x, *_), (y, *_) = b.take(True), whole.take(True)
    assert all((p == q).all() for p, q in zip(x, y, strict=True))
    assert co.spelled_once(*(np.concatenate([v, v]) for v in (np.array([5, 6], np.uint64), np.array([0, 0]), np.array([1, 2]), np.frombuffer(b"abb", np.uint8))))[0].tolist() == [5, 6]
    with pytest.raises(RuntimeError):
        co.spelled_once(np.array([5, 5], np.uint64), np.array([0, 0]), np.array([1, 1]), np.frombuffer(b"ab", np.uint8))


def test_frequent_words_and_pairs_are_split():
    """A word in a third of all grams does not fill one bucket, nor does a pair."""
    rng = np.random.default_rng(3)
    n = 30_000
    h = [rng.integers(1, 1 << 63, n).astype(np.uint64) for _ in range(3)]
    h[0][:n // 3] = 77
    h[1][:n // 4] = 88
    even = co.Deal(20, [], [])
    assert np.bincount(even.gram(*h)).max() > 5 * n / 20
    pair = int(co.pair(np.array([77], np.uint64), np.array([88], np.uint64))[0])
    deal = co.Deal(20, [77], [pair])
    assert np.bincount(deal.gram(*h), minlength=20).max() < 1.3 * n / 20
