"""Operator 4 and the corpus pipeline."""

import re

import numpy as np
import pytest
from brute import decontaminate, near_duplicates, repeats
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from basketry.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, share=1.5):
    """The contract's rounds, in exact arithmetic."""
    from fractions import Fraction
    w = [(3, 1, 2)[k % 3] for k in range(len(sizes))]
    out, left, open_ = [Fraction(0)] * len(sizes), Fraction(3, 2) * sum(sizes), set(range(len(sizes)))
    while open_:
        part = {k: left * w[k] / sum(w[j] for j in open_) for k in open_}
        over = {k for k in open_ if part[k] > 2 * sizes[k]}
        for k in over or open_:
            out[k] = Fraction(2 * sizes[k]) if over else part[k]
        if not over:
            break
        left -= sum(out[k] for k in over)
        open_ -= over
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=12))
def test_targets(sizes):
    got, want = mixing.targets(sizes), brute_targets(sizes)
    assert all(abs(a - float(b)) <= 1e-6 * max(1, float(b)) for a, b in zip(got, want, strict=True))


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 100, 1000])
def test_permutation(n):
    p = mixing.permute(np.arange(n), n, 77)
    assert sorted(p.tolist()) == list(range(n))
    assert mixing.permute(p, n, 77, back=True).tolist() == list(range(n))


def check_mix(docs, m):
    d = mixing.per_document(m).toPandas()
    rows = docs.toPandas()
    assert len(d) == len(rows) and sorted(d["size"]) == sorted(len(WORD.findall(t or "")) for t in rows.text)
    assert (d.taken <= 2 * d["size"]).all()
    assert abs(d.taken.sum() - sum(round(t) for t in m.plan.target)) == 0
    return d


def test_mix_of_a_table(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    m = mixing.mix(docs)
    d = check_mix(docs, m)
    by = d.merge(docs.select("doc_id", "source").toPandas()).groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("size", "sum"), of=("source_size", "first"))
    assert (abs(by.taken - by.target) <= 0.5 + 1e-9).all() and (by["size"] == by.of).all()
    again = mixing.per_document(mixing.mix(docs.repartition(7))).toPandas()
    assert d.sort_values(["doc_id"]).taken.tolist() == again.sort_values(["doc_id"]).taken.tolist()
    # the slots: every word of a source at most twice, blocks of the fixed length, shards full
    s = m.spans.toPandas()
    slots = s.groupby(["shard", "slot"]).n_words.sum()
    assert (slots <= mixing.BLOCK).all() and (slots < mixing.BLOCK).sum() <= 3 * len(m.plan.sources)
    s["last"] = s.first_word + s.n_words
    size = d.set_index("doc_id")["size"]
    assert (s["last"] <= s.doc_id.map(size)).all() and s.slot.groupby(s.shard).max().max() < mixing.SHARD_SLOTS


def test_mix_edge_cases(spark, make_docs, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_DOCS", 4)
    base = [(i, "w " * (i + 1), "en", f"s{i % 3}", 1, 0, "", "") for i in range(20)]
    odd = [(30, None, "en", None, 0, 0, "", ""), (31, "a b c", "en", None, 0, 0, "", ""), (None, "x", "en", "zz", 0, 0, "", ""), (1, "w w", "en", "s1", 1, 0, "", ""),
           (40, "", "en", "void", 0, 0, "", ""), (41, "long " * 20_000, "en", "Über", 0, 0, "", ""), (1, "w w", "en", "s1", 1, 0, "", "")]
    docs = make_docs(base + odd)
    m = mixing.mix(docs, shard_slots=16)
    check_mix(docs, m)
    assert m.plan.sources == ["s0", "s1", "s2", "void", "zz", "Über", None]
    none = mixing.per_document(mixing.mix(docs.limit(0)))
    assert none.count() == 0
    assert mixing.per_document(mixing.mix(docs.where("source = 'void'"))).first().taken == 0


# --------------------------------------------------------------------- pipeline

def test_pipeline_by_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "repeated_passages", "contamination", "mixing"]
    now = stages["language_id"](spark, docs, sf_small).cache()
    assert now.columns == columns and now.count() >= 198
    rows = [(r.doc_id, r.text) for r in now.select("doc_id", "text").collect()]
    now = stages["near_duplicates"](spark, now, sf_small).cache()
    want = {i for i, (_, _, g) in near_duplicates(rows).items() if i == g}
    assert now.columns == columns and {r.doc_id for r in now.select("doc_id").collect()} == want and now.count() == len(want)
    rows = [(r.doc_id, r.text) for r in now.select("doc_id", "text").collect()]
    now = stages["repeated_passages"](spark, now, sf_small).cache()
    cut = {x[0]: x for x in repeats(rows)}
    texts = dict(rows)
    got = now.toPandas()
    assert now.columns == columns and len(got) == len(rows) and (got.n_chars == got.text.str.len()).all()
    for r in got.itertuples():
        gone = len(texts[r.doc_id].encode()) - len(r.text.encode())
        assert cut[r.doc_id][2] - 6 * cut[r.doc_id][3] <= gone <= cut[r.doc_id][2]
    rows = [(r.doc_id, r.text) for r in got.itertuples()]
    now = stages["contamination"](spark, now, sf_small).cache()
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    clean = {i for i, (n, hit, _) in decontaminate(rows, bench).items() if not (hit and 20 * hit >= n)}
    assert now.columns == columns and {r.doc_id for r in now.select("doc_id").collect()} == clean
    last = stages["mixing"](spark, now, sf_small).toPandas()
    assert set(last.doc_id) == clean and (last.taken <= 2 * last["size"]).all()
    total = last["size"].sum()
    assert abs(last.taken.sum() - 1.5 * total) <= len(set(last.source)) or last.taken.sum() <= 1.5 * total


def test_pipeline_runs_on_odd_rows(spark, make_docs, sf_small):
    docs = make_docs([(1, "the house and the garden of the town " * 9), (1, "the house and the garden of the town " * 9), (2, None), (3, ""), (None, "the garden and the town are here " * 5)])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_small)
    assert sorted(docs.columns[:8]) == sorted(["doc_id", "text", "lang", "source", "n_chars", "n_words", "spans", "score"]) and docs.count() == 2
    empty = make_docs([(1, "x")]).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf_small)
    assert empty.count() == 0
