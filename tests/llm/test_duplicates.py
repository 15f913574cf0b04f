"""Operators 3, 6, 7 and 9: against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from brute import components, crc, near_duplicates as brute_near, repeats, suffix_tree as brute_tree
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import common, graph, neardup, neighbours, suffix_tree, suffixes


def texts(seed, n):
    """Random prose with copies, near copies, shared lines and odd rows."""
    r = random.Random(seed)
    vocab = ["".join(r.choices("abcdeéßñ", k=r.randint(1, 6))) for _ in range(400)]
    line = " ".join(r.choices(vocab, k=25))
    out = []
    for i in range(n):
        kind = r.random()
        if out and kind < 0.15:
            t = r.choice(out)[1]
        elif out and kind < 0.4:
            w = (r.choice(out)[1] or "x").split(" ")
            for _ in range(r.randint(1, 4)):
                w[r.randrange(len(w))] = r.choice(vocab)
            t = " ".join(w)
        else:
            t = " ".join(r.choices(vocab, k=r.randint(1, 120)))
        out.append((i, t + ("\n" + line if r.random() < 0.3 else "")))
    return out + [(n, ""), (n + 1, None), (n + 2, "ab"), (n + 3, "ab"), (n + 4, "a" * 5000), (n + 5, "a" * 120), (n + 6, "\x00" * 70 + "z"), (n + 7, "\x00" * 90)]


# ----------------------------------------------------------------- suffix dedup

@pytest.mark.parametrize("small", [False, True])
def test_repeats_by_brute_force(spark, make_docs, monkeypatch, small):
    if small:  # many batches, hash ranges and buckets
        for k, v in (("BATCH_BYTES", 6_000), ("RANGE_BYTES", 9_000), ("BUCKET_BYTES", 2_500)):
            monkeypatch.setattr(suffixes, k, v)
    rows = texts(3, 90)
    got = suffixes.remove_repeats(make_docs(rows)).toPandas()
    want = {x[0]: x[1:] for x in repeats(rows)}
    assert len(got) == len(rows)
    for r in got.itertuples():
        import hashlib
        assert (r.n_bytes, r.n_removed, len(r.spans_), hashlib.sha256(r.kept).hexdigest()) == want[r.doc_id]
    assert (got.spans == "mine").all()


def test_repeats_edge_cases(spark, make_docs):
    t = "the quick brown fox jumps over the lazy dog and runs away from it all"
    docs = make_docs([(5, t), (5, t), (2, t + "!"), (None, t), (9, None), (2, "other " + t), (7, "é" * 40), (8, "xé" + "é" * 39)])
    got = suffixes.remove_repeats(docs, whole_chars=True).toPandas()
    n = {(-1 if r.doc_id != r.doc_id else int(r.doc_id), r.text): r.n_removed for r in got.itertuples()}
    assert len(got) == 8 and n[5, t] == len(t) and n[-1, t] == len(t) and n[2, t + "!"] == 0 and n[2, "other " + t] == 0 and n[9, None] == 0
    assert n[8, "xé" + "é" * 39] == 80
    assert all(bytes(k).decode() is not None for k in got.kept)
    assert suffixes.remove_repeats(docs.limit(0)).count() == 0
    clash = spark.createDataFrame([(1, t, 7, 8, 9, 10), (2, t, 7, 8, 9, 10)], "doc_id long, text string, _text int, _rank int, _digest int, _b int")
    assert sorted(r.n_removed for r in suffixes.remove_repeats(clash).collect()) == [0, len(t)]
    assert neardup.keep_one(clash.withColumnsRenamed({"_text": "_doc", "_rank": "_row", "_digest": "_k", "_b": "_r"})).count() == 1


def test_multikey_sort():
    r = np.random.default_rng(1)
    m = r.integers(0, 3, (500, 6)).astype(np.uint64)
    assert m[suffixes.multikey_sort(m)].tolist() == sorted(m.tolist())


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab", max_size=200), min_size=1, max_size=6))
def test_minimizers_meet(docs):
    """Every 50-byte window holds a minimizer, and equal windows the same one."""
    data = "".join(docs).encode()
    off = np.concatenate(([0], np.cumsum([len(d) for d in docs])))
    p, h = suffixes.anchors(np.frombuffer(data, np.uint8), off)
    where, at = set(p.tolist()), {}
    for a, z in zip(off[:-1], off[1:], strict=True):
        for s in range(a, z - suffixes.LENGTH + 1):
            inside = tuple(q - s for q in range(s, s + suffixes.SPAN) if q in where)
            assert inside
            at.setdefault(data[s:s + 50], []).append(set(inside))
    assert all(set.intersection(*x) for x in at.values())


# ------------------------------------------------------------------ Jaccard join

def test_near_duplicates_by_brute_force(spark, make_docs):
    rows = texts(11, 120)
    got = neardup.near_duplicates(make_docs(rows), block=8).toPandas()
    want = brute_near(rows)
    assert len(got) == len(rows)
    for r in got.itertuples():
        assert (r.class_id, r.n_links, r.group_id) == want[r.doc_id]
        assert r.kept == (r.doc_id == r.group_id)


def test_near_duplicates_of_a_large_group(spark, make_docs):
    """A base and many copies whose edits differ: most pairs of copies lie below the threshold."""
    r = random.Random(5)
    base = [f"w{r.randint(0, 9999)}" for _ in range(100)]
    rows = [(0, " ".join(base))]
    for i in range(1, 120):
        w = list(base)
        for _ in range(2):
            w[r.randrange(100)] = f"e{i}{r.randint(0, 99)}"
        rows.append((i, " ".join(w)))
    got = neardup.near_duplicates(make_docs(rows[1:] + [(500, rows[0][1])]), block=16).toPandas().set_index("doc_id")
    want = brute_near(rows[1:] + [(500, rows[0][1])])
    assert all((got.class_id[i], got.n_links[i], got.group_id[i]) == want[i] for i in want)


def test_near_duplicate_edge_cases(spark, make_docs):
    t = "one two three four five six seven eight nine ten"
    docs = make_docs([(3, t), (3, t), (None, t.upper()), (1, "one"), (2, "one"), (4, None), (5, ""), (3, "another text of some words here"), (6, "!!")])
    got = neardup.near_duplicates(docs).toPandas()
    three = got[got.doc_id == 3]
    assert len(got) == 8 and sorted(three.n_links) == [0, 1] and got[got.doc_id.isna()].group_id.tolist() == [3]
    assert got[got.doc_id == 2].group_id.tolist() == [1] and got[got.doc_id == 5].group_id.tolist() == [5]
    kept = neardup.keep_one(docs).toPandas()
    assert sorted(map(int, kept.doc_id)) == [1, 3, 3, 4, 5, 6] and kept.columns.tolist() == docs.columns
    assert neardup.near_duplicates(docs.limit(0)).count() == 0 and neardup.keep_one(docs.limit(0)).count() == 0


def test_near_duplicates_of_rows_without_own_id(spark, make_docs):
    """Different texts of null or repeated ids are documents of their own."""
    r = random.Random(9)
    prose = [[f"w{r.randint(0, 9999)}" for _ in range(60)] for _ in range(6)]
    near = lambda q, e: " ".join([*prose[q][:-1], e])
    rows = [(1, " ".join(prose[0])), (None, near(0, "x")), (None, " ".join(prose[1])), (None, " ".join(prose[2])), (None, near(2, "y")),
            (7, " ".join(prose[3])), (7, " ".join(prose[4])), (7, near(4, "z")), (9, near(3, "u")), (None, " ".join(prose[5]))]
    full = make_docs(rows)
    got = {(x.row, x.doc_id): x for x in neardup.near_duplicates(full).collect()}
    rows_of = {(x.h, x.doc_id): x.text for x in full.selectExpr("xxhash64(text) h", "doc_id", "text").collect()}
    got = {rows_of[k]: x for k, x in got.items()}
    none = neardup.NO_ID
    assert [got[t].group_id for _, t in rows] == [1, 1, none, none, none, 7, 7, 7, 7, none]
    assert [got[t].n_links for _, t in rows] == [1, 1, 0, 1, 1, 1, 1, 1, 1, 0]
    kept = [x.text for x in neardup.keep_one(full).collect()]
    at = [{t for _, t in rows[a:z]} for a, z in ((2, 3), (3, 5), (6, 8), (9, 10))]
    assert len(kept) == 6 and all(len(x & set(kept)) == 1 for x in at) and rows[0][1] in kept and rows[5][1] in kept


def test_candidate_edges_are_planned_apart(spark, make_docs, monkeypatch):
    """One plan of the rounds' result, the mixed buckets and their block pairs filled the driver."""
    seen, real = [], neardup.components
    monkeypatch.setattr(neardup, "components", lambda e: (seen.append(e._jdf.queryExecution().executedPlan().toString().count("Exchange")), real(e))[1])
    neardup.near_duplicates(make_docs([(i, f"a b c d e f g h {i % 3}") for i in range(9)])).collect()
    assert len(seen) == 3 and max(seen) == 0      # the second planned all of it at once


def test_banding_reaches_recall():
    for t in (0.5, 0.8, 0.9):
        bands, rows = neardup.banding(t, 0.999)
        assert 1 - (1 - t**rows) ** bands >= 0.999


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_forest_spans(pairs):
    ok = np.zeros((31, 31), bool)
    for a, b in pairs:
        ok[a, b] = a != b
    every = np.arange(31)
    edges = neardup.forest(ok, every, every, 31)
    assert components(range(31), edges) == components(range(31), [p for p in pairs if p[0] != p[1]]) and len(edges) < 31


def test_components_plan_each_star_apart(spark, monkeypatch):
    """One plan of a round held its large stars three times; the driver's memory grew with it."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(40) if i % 10 < 8] + [(100, i) for i in range(50, 80)], "a long, b long")
    joins, real = [], type(edges).checkpoint
    monkeypatch.setattr(type(edges), "checkpoint", lambda df, *a: (joins.append(df._jdf.queryExecution().executedPlan().toString().count("Join ")), real(df, *a))[1])
    found = {(r.node, r.component) for r in graph.components(edges).collect()}
    assert max(joins) == 1
    assert found == {(i, i - i % 10) for i in range(40) if i % 10 < 9} | {(i, 50) for i in [*range(50, 80), 100]}


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + r.randint(0, 40), 100 + r.randint(0, 40)) for _ in range(30)] + [(7, 7)]
    want = components(sorted({x for e in edges for x in e}), edges)
    got = dict(graph.components(spark.createDataFrame(edges, "a long, b long")).toPandas().itertuples(index=False, name=None))
    touched = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {i: want[i] for i in touched}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -------------------------------------------------------------------- embeddings

def vectors(seed, n, dim=16):
    r = np.random.default_rng(seed)
    base = r.standard_normal((n // 6, dim))
    x = np.concatenate([base, base[r.integers(0, len(base), n - len(base))] + r.standard_normal((n - len(base), dim)) * 0.18])
    return x[r.permutation(len(x))]


def brute_links(rows, threshold=0.95):
    good = {i: np.asarray(v, float) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    links = [(a, b) for a in good for b in good if a < b and len(good[a]) == len(good[b])
             and good[a] @ good[b] / (np.linalg.norm(good[a]) * np.linalg.norm(good[b])) >= threshold]
    n = Counter(x for p in links for x in p)
    return n, components([i for i, _ in rows], links)


def test_embeddings_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 32)
    x = vectors(4, 400)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(400 + i, (x[7] * (1 + i)).tolist()) for i in range(40)]
    rows += [(900, None), (901, [0.0] * 16), (902, [float("nan")] + [1.0] * 15), (903, [None] + [1.0] * 15), (904, [float("inf")] * 16), (905, [1.0, 2.0]), (906, [2.0, 4.0]), (907, [])]
    df = spark.createDataFrame([(i, v, 0, "mine") for i, v in rows], "vec_id long, embedding array<double>, label int, kept string")
    got = neighbours.near_vectors(df).toPandas().set_index("vec_id")
    n, comp = brute_links(rows)
    assert len(got) == len(rows)
    assert sum(got.n_links) >= 0.999 * sum(n.values()) and all(got.n_links[i] <= n[i] for i, _ in rows)
    assert sum(got.component_id[i] != comp[i] for i, _ in rows) <= 1
    assert got.n_links[905] == 1 and got.component_id[906] == 905 and (got.n_links[[900, 901, 902, 903, 904, 907]] == 0).all()
    assert ((got.component_id == got.index) == got.kept).all()


def test_embeddings_of_dense_clumps(spark, monkeypatch):
    """Lists are filled inside the clumps; the links between clumps (0.96) lie beyond them."""
    monkeypatch.setattr(neighbours, "TABLES", 2)
    monkeypatch.setattr(neighbours, "AUDITS", 1)
    r = np.random.default_rng(6)
    d = 24
    rows, at = [], 0
    for _ in range(3):
        q = np.linalg.qr(r.standard_normal((d, 2)))[0]
        for c in (q[:, 0], 0.96 * q[:, 0] + np.sqrt(1 - 0.96**2) * q[:, 1]):
            for _ in range(150):
                rows.append((at, (c + r.standard_normal(d) * 0.004).tolist()))
                at += 1
    rows = [(i, rows[j][1]) for i, j in enumerate(r.permutation(len(rows)))]
    got = neighbours.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas().set_index("vec_id")
    n, comp = brute_links(rows)
    assert len(set(comp.values())) == 3
    assert all(got.component_id[i] == comp[i] and got.n_links[i] == n[i] for i, _ in rows)


def test_audit_is_not_ruled_by_hot_components(spark, monkeypatch):
    """Missing all pairs beside a large group that is found whole is not a pass."""
    assert neighbours.recall([(1999, 1999, 1.0)] * 200 + [(0, 1, 1.0)] * 3) == 0.0
    assert neighbours.recall([(5, 5, 1.0), (0, 0, 9.0)]) == 1.0 and neighbours.recall([]) == 1.0
    monkeypatch.setattr(neighbours, "AUDITS", 1)
    monkeypatch.setattr(neighbours, "_true_links", lambda pairs, vecs, threshold: pairs.where("a < 0").select("a", "b"))
    df = spark.createDataFrame([(i, [1.0, 0.1 * (i % 2) + 3 * (i // 2)]) for i in range(4)], "vec_id long, embedding array<double>")
    with pytest.raises(RuntimeError, match="recall"):
        neighbours.near_vectors(df)


def test_embeddings_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TABLES", 1)
    monkeypatch.setattr(neighbours, "ROUNDS", 1)
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (2, [1.0, 0.1])], "vec_id long, embedding array<float>")
    got = neighbours.near_vectors(df).toPandas().sort_values("vec_id")
    assert got.vec_id.tolist()[:2] == [1, 2] and len(got) == 3 and got.n_links.tolist() == [2, 2, 2] and got.component_id.tolist() == [1, 1, 1]
    assert got.kept.tolist() == [True, False, False]
    assert neighbours.near_vectors(df.limit(0)).count() == 0


# ---------------------------------------------------------------------- suffix tree

@pytest.mark.parametrize("small", [False, True])
def test_scores_by_brute_force(spark, make_docs, monkeypatch, small):
    if small:
        monkeypatch.setattr(suffix_tree, "BATCH_BYTES", 5_000)
        monkeypatch.setattr(suffix_tree, "RANGE_BYTES", 4_000)
    rows = texts(8, 150) + [(3, "repeated id"), (3, "repeated id"), (400, "A b\tC d   e")]
    got = suffix_tree.score_texts(make_docs(rows), common.crc_mod("doc_id", 7) != 2).toPandas().sort_values(["doc_id", "score"])
    want = sorted(brute_tree(rows, lambda i: crc(i, 7) != 2), key=lambda x: (x[0], x[5]))
    assert len(got) == len(want)
    for r, w in zip(got.itertuples(), want, strict=True):
        assert (r.doc_id, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert abs(r.base_score - w[4]) < 1e-6 and abs(r.score - w[5]) < 1e-4 * max(1, abs(w[5])) and r.held_out == (crc(r.doc_id, 7) == 2)


def test_score_edge_cases(spark, make_docs):
    docs = make_docs([(None, "a b"), (1, None), (2, "a b")])
    r = suffix_tree.score_texts(docs, common.crc_mod("doc_id", 7) != 2).toPandas()
    assert len(r) == 3 and (r.train_tokens == 1 + 3 * (r.held_out.sum() == 0) + r[~r.held_out].n_tokens.sum() - 1 - 3 * (r.held_out.sum() == 0)).all()
    from pyspark.sql import functions as F
    none = suffix_tree.score_texts(docs, F.lit(False)).toPandas()
    assert (none.train_tokens == 0).all() and (none.base_score == 0).all() and (none.n_known == 0).all()
    assert suffix_tree.score_texts(docs.limit(0), F.lit(True)).count() == 0


def test_scoring_leaves_no_shuffle_files_of_its_passes(spark, make_docs, monkeypatch):
    """They stayed until the driver's garbage happened to be collected; so a second run passed its disk limit."""
    import time
    kept = lambda: {str(b) for b in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ").split() if b.startswith("shuffle")}
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    option = spark.conf.get(key, None)
    monkeypatch.setattr(suffix_tree, "release", lambda s: None)
    docs = make_docs([(i, f"a b c d {i % 3} e f {i % 5}") for i in range(40)]).localCheckpoint()
    held = kept()
    scored = suffix_tree.score_texts(docs, common.crc_mod("doc_id", 7) != 2)
    until = time.time() + 20
    while kept() - held and time.time() < until:
        time.sleep(0.2)
    # the byte count of the texts is no checkpoint: its one-row shuffle may stay
    assert len({b.split("_")[1] for b in kept() - held}) <= 1
    assert spark.conf.get(key, None) == option and scored.count() == 40


def test_held_out_texts_score_better_than_the_base(spark, sf_small):
    r = suffix_tree.op6(spark, sf_small).toPandas()
    held = r[r.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_embeddings_of_repeated_and_missing_ids(spark, oracle):
    """A vec_id with several vectors loses no link, and rows without one stay."""
    import numpy as np
    rng = np.random.default_rng(8)
    base = rng.normal(size=(12, 6))
    rows = [(int(rng.integers(0, 25)) if rng.random() < 0.7 else None, (base[rng.integers(12)] + rng.normal(size=6) * rng.choice([0, 0.05, 0.3])).round(6).tolist()) for _ in range(90)]
    rows += [(3, None), (50, None), (51, [0.0] * 6), (None, None), (None, [0.0] * 6), (52, [1.0, float("nan")] + [0.0] * 4), (7, [2.0] * 5), (8, [2.0] * 5), (None, [2.0] * 5), (None, [2.0] * 5)]
    rows += rows[:9]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.near_vectors(df).toPandas()
    want = oracle(neighbours.OP3_SQL, embeddings=spark.createDataFrame(rows, "vec_id long, embedding array<double>").toPandas().astype({"vec_id": "Int64"}))
    key = lambda d: sorted((-1 if x.vec_id is None or x.vec_id != x.vec_id else int(x.vec_id), int(x.n_links), -1 if x.component_id != x.component_id or x.component_id is None else int(x.component_id), bool(x.kept))
                           for x in d.astype(object).where(d.notna(), None).itertuples())
    assert key(got) == key(want)
