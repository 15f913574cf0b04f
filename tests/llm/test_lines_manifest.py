"""Operators 11 and 12: against DuckDB SQL and brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from brute import same
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketry.llm import lines, manifest

LONG = "This passage stands in documents."
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, kept int, keep int, at string, hi string, leaf string, root string, path string, h string"


def full(rows):
    return [(i, t, lang, "s", None if t is None else len(t), "x", 1, 2, "x", "x", "x", "x", "x", "x") for i, t, lang in rows]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# ------------------------------------------------------------------ operator 11

def brute_lines(rows):
    key = lambda x: "".join(c.lower() if c.isascii() else c for c in x.strip(" \t\n\x0b\x0c\r"))
    place = lambda i: -(1 << 63) if i is None else i
    docs = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20:
                docs[key(x)].add(place(i))
    out = []
    for i, t in rows:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if len(docs[key(x)]) < 3 or max(docs[key(x)]) == place(i)]
        out.append((i, len(all_lines), len(all_lines) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=repr)


LINE_ROWS = [(1, LONG), (2, f"a\n  {LONG.upper()}\t\n{LONG}"), (3, f"{LONG}\nb\n{LONG}"), (4, None), (5, ""), (6, "\n\n"), (7, "short\nshort"), (8, "short"), (9, "short"),
             (10, "ééééééééééééééééééé"), (11, "ééééééééééééééééééé"), (12, "ééééééééééééééééééé"), (13, "éééééééééééééééééééé"), (14, "éééééééééééééééééééé\r"), (15, "ÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉ"), (16, "éééééééééééééééééééé"),
             (None, f"{LONG}\nno id"), (None, "another text of no id"), (17, "only two documents hold this"), (17, "only two documents hold this"), (18, "only two documents hold this"), (3, "another text of three\n" + LONG),
             (19, "w" * 300_000 + "\n" + LONG + " \n" + "w" * 300_000), (20, "w" * 300_000), (21, "w" * 300_000 + "\r\n\x0b")]


def test_lines_against_brute_force_and_sql(spark, oracle, monkeypatch, tmp_path):
    docs = spark.createDataFrame(full([(*r, "en") for r in LINE_ROWS]), SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = lines.op11(spark, str(tmp_path)).toPandas()
    rows = sorted(((None if r.doc_id != r.doc_id else int(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256) for r in got.itertuples()), key=repr)
    assert rows == brute_lines(LINE_ROWS)
    same(got, oracle(lines.OP11_SQL, documents=docs.toPandas().astype({"doc_id": "Int64"})))
    assert lines.keep_bitmaps(docs.limit(0)).count() == 0


def test_bitmaps_hold_every_line(spark):
    docs = spark.createDataFrame(full([(i, f"{i}\n{LONG}\n" * 3000, "en") for i in range(4)]), SCHEMA)
    for r in lines.keep_bitmaps(docs).collect():
        keep = lines.unpack_bitmap(r.keep, r.n_lines)
        assert len(keep) == r.n_lines == 6001 and (~keep).sum() == r.n_dropped == (0 if r.doc == 3 else 3000)
        assert len(r.keep) < 200
    text = b"a\n\nb\n"
    for bits in range(16):
        keep = np.array([bits >> k & 1 for k in range(4)], bool)
        assert lines.keep_lines(text, keep) == b"\n".join(x for x, k in zip(text.split(b"\n"), keep, strict=True) if k)


def test_a_hot_line_spans_partitions(spark):
    """A line of every document is settled across the borders of many partitions."""
    rows = [(i, f"{LONG}\nown line of document number {i % 700}\n{LONG}") for i in range(2000)] + [(None, LONG)] * 600
    docs = spark.createDataFrame(full([(*r, "en") for r in rows]), SCHEMA).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = lines.kept_texts(docs, lines.keep_bitmaps(docs), digest=True)
        out = sorted(((r[0], r[1], r[2], r[3]) for r in got.collect()), key=repr)
        assert out == brute_lines(rows)
        index = lines._keys(docs, "text", "doc_id").mapInArrow(lines._index(20), lines.INDEX)
        order = ["hi", "lo", F.col("doc").desc(), "row", "at"]
        parts = index.select("doc", "row", F.inline("lines")).repartitionByRange(*order).groupBy(F.spark_partition_id()).count().toPandas()["count"]
        assert len(parts) >= 6 and parts.max() <= 3 * parts.mean()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 5), st.integers(0, 2)), max_size=40), st.lists(st.integers(0, 40), max_size=8), st.integers(1, 7), st.integers(2, 4))
def test_stream_for_any_partitions_and_batches(found, cuts, size, least):
    """Sorted lines cut into partitions and batches anywhere give the same verdicts."""
    rows = sorted(((h, h, -d, r, k) for k, (h, d, r) in enumerate(found)))
    docs = defaultdict(set)
    for h, _, d, *_ in rows:
        docs[h].add(-d)
    want = sorted((-d, k) for h, _, d, _, k in rows if len(docs[h]) >= least and -d != max(docs[h]))
    said = []
    edges = sorted({0, len(rows), *(c for c in cuts if c < len(rows))})
    for a, b in zip(edges, edges[1:], strict=False):
        s = lines.Stream(least)
        for k in range(a, b, size):
            z = np.array(rows[k:min(b, k + size)], np.int64)
            z[:, 2] *= -1
            for batch in s.batch(list(z.T)):
                said += batch.to_pylist()
        for batch in s.end():
            said += batch.to_pylist()
    largest = defaultdict(set)
    for x in said:
        if x["kind"] == lines.LARGEST:
            largest[x["hi"]].add(x["doc"])
    got = [(x["doc"], x["at"]) for x in said if x["kind"] == lines.DROP]
    got += [(x["doc"], x["at"]) for x in said if x["kind"] == lines.OPEN and len(largest[x["hi"]]) >= least and x["doc"] != max(largest[x["hi"]])]
    assert sorted(got) == want


# ------------------------------------------------------------------ operator 12

def brute_tree(rows):
    def item(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return sha("".join(item(v) for v in (r[0], r[3], r[2], r[4], text)))

    def levels(hashes):
        out = [hashes]
        while len(out[-1]) > 1:
            h = out[-1]
            out.append([sha("".join(h[k:k + 8])) for k in range(0, len(h), 8)])
        return out

    def path(tree, i):
        out = []
        for level in tree[:-1]:
            a = i // 8 * 8
            out.append(("".join(level[a:i]), "".join(level[i + 1:a + 8])))
            i //= 8
        return out

    groups = defaultdict(list)
    for r in rows:
        fake = r[1]
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
            fake = "".join(c.lower() if c.isascii() else c for c in r[1])
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf(r, r[1]), leaf(r, fake), r[0]))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: levels([x[2] for x in sorted(groups[g])]) for g in langs}
    top = levels([trees[g][-1][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for i, (_, _, own, fake, doc) in enumerate(sorted(groups[g])):
            p = path(trees[g], i) + path(top, k)
            acc = fake
            for left, right in p:
                acc = sha(left + acc + right)
            out.append((doc, own, trees[g][-1][0], top[-1][0], sha("".join(a + b for a, b in p)), acc, acc == top[-1][0]))
    return sorted(out, key=repr)


def tree_rows(sizes, seed=0):
    rng = random.Random(seed)
    ids = rng.sample(range(100_000), sum(sizes.values()))
    rows = [(ids.pop(), rng.choice(["Some Text", "plain", None, "", "ÄÖ and Q", "ẞİK"]) and f"T{rng.random()} ÄÜ", g) for g, n in sizes.items() for _ in range(n)]
    rng.shuffle(rows)
    return rows


def check_tree(spark, oracle, tmp_path, rows, sql=True):
    docs = spark.createDataFrame(full(rows), SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = manifest.op12(spark, str(tmp_path)).toPandas()
    out = sorted(((None if r.doc_id != r.doc_id else int(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, bool(r.verified)) for r in got.itertuples()), key=repr)
    assert out == brute_tree([r[:5] for r in full(rows)])
    if sql:
        same(got, oracle(manifest.OP12_SQL, documents=docs.toPandas().astype({"doc_id": "Int64", "n_chars": "Int64"})))


@pytest.mark.parametrize("sizes", [{"en": 1}, {None: 1, "": 2, "de": 8, "en": 9, "é": 64, "zz": 65}, {"en": 700, None: 3}, {f"l{k}": 1 + k % 3 for k in range(70)}], ids=["one", "borders", "two blocks", "many groups"])
def test_trees_against_brute_force_and_sql(spark, oracle, tmp_path, sizes):
    check_tree(spark, oracle, tmp_path, tree_rows(sizes))


def test_three_passes_of_small_blocks(spark, oracle, tmp_path, monkeypatch):
    """Blocks of eight: more passes than any table of a test needs otherwise."""
    monkeypatch.setattr(manifest, "DEPTH", 1)
    monkeypatch.setattr(manifest.emit, "__defaults__", (1,))
    check_tree(spark, oracle, tmp_path, tree_rows({"en": 130, "de": 9, "fr": 1}), sql=False)


def test_tree_edge_cases(spark, oracle, tmp_path):
    rows = [(None, "No Id", "en"), (None, "no id either", "en"), (None, None, None), (3, None, "en"), (3, "", "en"), (3, "Same", "en"), (3, "Same", "en"), (9, "Ä" * 200_000 + "Long", None), (12, "x", "en")]
    rows += [(k, "ALL CAPS İ", "en") for k in range(20, 40)]
    check_tree(spark, oracle, tmp_path, rows)
    none = spark.createDataFrame([], SCHEMA)
    assert manifest.manifest(none, F.sha2("text", 256), F.col("lang"), F.col("doc_id")).count() == 0


def test_tampering_is_found_and_equal_rows_share_a_task_no_more_than_others(spark):
    docs = spark.createDataFrame(full([(7, "Same", "en")] * 3000 + [(k, "x", "en") for k in range(3000)]), SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        one = docs.select(F.lit("1en").alias("grp"), F.col("doc_id").alias("id"), F.lit(b"x").alias("leaf")).checkpoint()
        r = manifest.ranked(one, "grp", ["id", "leaf"])
        assert sorted(x[0] for x in r.select("rank").collect()) == list(range(6000)) and {x[0] for x in r.select("n").collect()} == {6000}
        parts = r.groupBy(F.spark_partition_id()).count().toPandas()["count"]
        assert parts.max() <= 3 * parts.mean()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    m = manifest.manifest(docs, F.sha2("text", 256), F.col("lang"), F.col("doc_id"), F.when(F.col("doc_id") == 7, F.sha2(F.lit("other"), 256)))
    bad = m.where(manifest.fold(F.col("path"), F.coalesce("fake", "leaf")) != F.col("root"))
    assert bad.count() == bad.where("id = 7").count() == 3001
