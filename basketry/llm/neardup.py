"""N-gram Jaccard join (operator 9): MinHash banding with exact verification.

Every text becomes the set of its 5-word shingles (a text of fewer words, but
not none, is one shingle).  Texts with equal sets form a class, represented by
the text of its least (doc_id, text hash); only representatives are compared.
Classes have numbers of their own, as several classes may share a doc_id.

1. Signatures: ``bands * rows`` minima; band and row counts are the cheapest
   that reach ``RECALL`` at the threshold.
2. Band hashes are shuffled.  In each bucket every member is paired with the
   bucket's smallest document, never with all.  Pairs whose whole signatures
   agree enough (a loose bound, ``SIGMAS`` standard errors below the
   threshold) are edges of a candidate graph.
3. Buckets that then hold several components are compared across components,
   in blocks, by signatures; a task passes on the edges that join components,
   not all pairs.  So every pair of a bucket that could be a link ends up in
   one candidate component.
4. Inside every candidate component all pairs are verified on the full shingle
   sets, block by block: links are counted for every member, and each block
   passes on a spanning forest of its true links.  The components of those are
   the groups.  Pairs are never emitted, however large a group is.

Defined results: null text is empty; documents without words link with
nothing and are classes of their own; rows that repeat doc_id and text share
one result; rows that share only doc_id are different documents of that id;
null doc_id rows count as id 2**63-1; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import MIX, U64, free_name, grams, lean, mix, release, table, text_slices, words
from basketry.llm.graph import block_pairs, components
from basketry.session import checkpoint_root

SHINGLE = 5
THRESHOLD = 0.8
#: Chance that a pair at the threshold shares a band, at least.
RECALL = 0.9999
SIGMAS = 6.0
#: Members of a block of a group.
BLOCK = 128
NO_ID = 2**63 - 1


def banding(threshold: float = THRESHOLD, recall: float = RECALL, noise: float = 0.3, weight: float = 40.0) -> tuple[int, int]:
    """(bands, rows): reaches ``recall`` at the threshold with the least cost,
    bands shuffled plus the chance that a pair of similarity ``noise`` meets."""
    best = None
    for rows in range(1, 13):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)))
        cost = bands * (1 + weight * noise**rows)
        if best is None or cost < best[0]:
            best = (cost, bands, rows)
    return best[1], best[2]


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, shingle hash) of a slice, sorted."""
    _, _, row, h = words(data, off)
    at, g = grams(h, row, k)
    r = row[at]
    n = np.bincount(row, minlength=len(off) - 1)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        first = np.concatenate(([0], np.cumsum(n)))[short]
        s = np.full(len(short), U64(k))
        for j in range(k - 1):
            more = n[short] > j
            s[more] = mix((s[more] ^ h[first[more] + j]) * MIX)
        r, g = np.concatenate((r, short)), np.concatenate((g, s))
    order = np.lexsort((g, r))
    r, g = r[order], g[order]
    new = np.concatenate(([True], (r[1:] != r[:-1]) | (g[1:] != g[:-1]))) if len(r) else np.zeros(0, bool)
    return r[new], g[new]


def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * MIX)
    return x[:n] | U64(1), x[n:]


def _signatures(bands: int, rows: int, k: int):
    mul, xor = _constants(bands * rows)

    def run(batches):
        for b in batches:
            parts = []
            for i, j, data, off in text_slices(b.column(1), 500_000):
                r, g = shingle_sets(data, off, k)
                n = np.bincount(r, minlength=j - i)
                full = np.flatnonzero(n)
                sig = np.zeros((j - i, len(mul)), np.uint32)
                ends = np.cumsum(n[full])
                starts = ends - n[full]
                c1, c2 = np.zeros(j - i, np.uint64), np.zeros(j - i, np.uint64)
                a = 0
                while a < len(full):  # chunks that stay in the processor's cache
                    z = max(a + 1, int(np.searchsorted(ends, starts[a] + 50_000, "right")))
                    x = g[starts[a]:ends[z - 1]]
                    at = starts[a:z] - starts[a]
                    for q in range(len(mul)):
                        sig[full[a:z], q] = np.minimum.reduceat((x ^ xor[q]) * mul[q], at) >> U64(32)
                    c1[full[a:z]] = np.add.reduceat(mix(x), at)
                    c2[full[a:z]] = np.add.reduceat(mix(x ^ MIX), at)
                    a = z
                parts.append((n, c1, c2, sig))
            cat = lambda q: np.concatenate([p[q] for p in parts]) if parts else np.zeros(0)  # noqa: B023, E731
            n = cat(0)
            sig = [x.tobytes() if m else None for p in parts for x, m in zip(p[3], p[0], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(cat(1).astype(np.uint64).view(np.int64)),
                                              pa.array(cat(2).astype(np.uint64).view(np.int64)), pa.array(sig, pa.binary())], ["doc", "row", "n", "c1", "c2", "sig"])
    return run


def _sets(k: int):
    def run(batches):
        for b in batches:
            for i, j, data, off in text_slices(b.column(1)):
                r, g = shingle_sets(data, off, k)
                cut = np.searchsorted(r, np.arange(j - i + 1))
                raw = g.astype("<u8")
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array([raw[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)], pa.binary())], ["doc", "shingles"])
    return run


def _agreeing(least: float, ratio: float):
    """The pairs (a, b) whose signatures and set sizes allow the threshold."""
    def run(batches):
        for b in batches:
            x = np.frombuffer(b"".join(b.column(2).to_pylist()), "<u4").reshape(b.num_rows, -1)
            y = np.frombuffer(b"".join(b.column(3).to_pylist()), "<u4").reshape(b.num_rows, -1)
            n, m = b.column(4).to_numpy(), b.column(5).to_numpy()
            ok = pa.array(((x == y).mean(1) >= least) & (np.minimum(n, m) >= ratio * np.maximum(n, m))) if b.num_rows else pa.array([], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(ok), b.column(1).filter(ok)], ["a", "b"])
    return run


def _cross(least: float, ratio: float, width: int):
    """Of the pairs of a block pair that lie in different components and whose
    signatures agree enough: those that join components."""
    def run(batches):
        for b in batches:
            out = ([], [])
            for lo, hi, rows in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                rows = rows.as_py()
                doc = np.array([r["doc"] for r in rows], np.int64)
                n = np.array([r["n"] for r in rows], float)
                mine = np.array([r["mine"] for r in rows])
                sig = np.frombuffer(b"".join(r["sig"] for r in rows), "<u4").reshape(len(rows), width)
                comp = np.unique([r["component"] for r in rows], return_inverse=True)[1]
                left, right = np.flatnonzero(mine == lo), np.flatnonzero(mine == hi)
                for i in left:
                    c = right[(comp[right] != comp[i]) & (np.minimum(n[right], n[i]) >= ratio * np.maximum(n[right], n[i]))]
                    c = c[(sig[c] == sig[i]).mean(1) >= least] if len(c) else c
                    for j in c[np.unique(comp[c], return_index=True)[1]]:
                        out[0].append(int(doc[i]))
                        out[1].append(int(doc[j]))
                        comp[comp == comp[j]] = comp[i]
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64())], ["a", "b"])
    return run


def jaccard_blocks(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float, step: int = 8192) -> np.ndarray:
    """Which pairs (left, right) of sets reach the threshold: products of strips of the incidence matrix."""
    n = np.array([len(s) for s in sets])
    _, col = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), n)
    order = np.argsort(col, kind="stable")
    col, row = col[order], row[order]
    shared = np.zeros((len(left), len(right)), np.float64)
    for a in range(0, int(col[-1]) + 1, step):
        x, y = np.searchsorted(col, (a, a + step))
        m = np.zeros((len(sets), step), np.float32)
        m[row[x:y], col[x:y] - a] = 1
        shared += m[left] @ m[right].T
    return shared / (n[left][:, None] + n[right][None, :] - shared) >= threshold


def forest(ok: np.ndarray, left: np.ndarray, right: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the pairs that are ok."""
    adj = np.zeros((size, size), bool)
    adj[np.ix_(left, right)] = ok
    adj |= adj.T
    seen, out = ~adj.any(1), []
    for start in range(size):
        if seen[start]:
            continue
        seen[start], todo = True, [start]
        while todo:
            u = todo.pop()
            new = np.flatnonzero(adj[u] & ~seen)
            seen[new] = True
            out += [(u, int(v)) for v in new]
            todo += new.tolist()
    return out


def _verified(threshold: float):
    """For a block pair, on full sets: links of every member with the other
    block (b is null), and a spanning forest of the links (links is null)."""
    def run(batches):
        for batch in batches:
            a, b, links = [], [], []
            for lo, hi, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                rows = rows.as_py()
                mine = np.array([r["mine"] for r in rows])
                size, doc = np.array([r["size"] for r in rows], np.int64), np.array([r["doc"] for r in rows], np.int64)
                left, right = np.flatnonzero(mine == lo), np.flatnonzero(mine == hi)
                ok = jaccard_blocks([np.frombuffer(r["shingles"], "<u8") for r in rows], left, right, threshold)
                if lo == hi:
                    np.fill_diagonal(ok, False)
                    who, n = doc[left], ok @ size[right]
                else:
                    who, n = np.concatenate((doc[left], doc[right])), np.concatenate((ok @ size[right], size[left] @ ok))
                on = n > 0
                edges = forest(ok, left, right, len(rows))
                a += who[on].tolist() + [int(doc[u]) for u, _ in edges]
                b += [None] * int(on.sum()) + [int(doc[v]) for _, v in edges]
                links += n[on].tolist() + [None] * len(edges)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(links, pa.int64())], ["a", "b", "links"])
    return run


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE,
                    threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """One row per (doc_id, text): doc_id, row (text hash), class_id, n_links
    (other documents at or above the threshold, copies included), group_id
    (smallest doc_id reachable by links) and kept (the least (doc_id, row) of the group)."""
    spark = docs.sparkSession
    checkpoint_root(spark)
    bands, rows = banding(threshold, recall)
    src = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    src = src.withColumn("row", F.xxhash64("t"))
    one = src.select("doc", "t", "row").mapInArrow(lean(_signatures(bands, rows, k)), "doc long, row long, n long, c1 long, c2 long, sig binary").checkpoint()
    ids = one.select("doc", "row", "n", "c1", "c2").distinct()
    worded = one.where("n > 0").groupBy("c1", "c2", "n").agg(F.first("sig").alias("sig"))
    sizes = ids.where("n > 0").groupBy("c1", "c2").agg(F.min(F.struct("doc", "row")).alias("low"), F.count(F.lit(1)).alias("size"))
    # from here to the verified groups, "doc" is the number of a class, fixed by the checkpoint
    classes = worded.join(sizes, ["c1", "c2"]).withColumn("doc", F.monotonically_increasing_id()).checkpoint()

    # buckets of band hashes; a member's partner is the bucket's smallest document
    band = F.explode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)),
                                 lambda b: F.xxhash64(b, F.substring(F.col("sig"), (b * (4 * rows) + 1).cast("int"), F.lit(4 * rows)))))
    slots = classes.select("doc", band.alias("key"))
    heads = slots.groupBy("key").agg(F.min("doc").alias("head"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    slots = slots.join(heads, "key").checkpoint()
    release(spark)
    stars = slots.where("doc != head").select(F.col("head").alias("a"), F.col("doc").alias("b")).distinct()
    width = bands * rows
    least = threshold - SIGMAS * math.sqrt(threshold * (1 - threshold) / width)
    info = classes.select("doc", "sig", "n")
    side = lambda c, x, m: info.select(F.col("doc").alias(c), F.col("sig").alias(x), F.col("n").alias(m))
    edges = (stars.join(side("a", "x", "n"), "a").join(side("b", "y", "m"), "b").select("a", "b", "x", "y", "n", "m")
             .mapInArrow(lean(_agreeing(least, threshold)), "a long, b long")).checkpoint()
    # what follows is cut by checkpoints, too: one plan of it all would fill the driver while it is adapted
    found = components(edges).checkpoint()
    # buckets with members of several components
    member = (slots.select("key", "doc").join(found.withColumnRenamed("node", "doc"), "doc", "left")
              .withColumn("component", F.coalesce("component", "doc")))
    mixed = member.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select("key")
    member = member.join(mixed, "key").checkpoint()
    release(spark)
    member = member.join(info, "doc")
    units = (block_pairs(member, "key", "doc", block).groupBy("key", "lo", "hi")
             .agg(F.collect_list(F.struct("doc", "component", "n", "mine", "sig")).alias("rows")).select("lo", "hi", "rows"))
    more = units.mapInArrow(lean(_cross(least, threshold, width)), "a long, b long").checkpoint()
    release(spark)
    found = components(edges.union(more)).checkpoint()
    release(spark)

    # full sets of the members of candidate components, from one row of each
    reps = classes.join(found.select(F.col("node").alias("doc")), "doc").select(F.col("doc").alias("k"), F.col("low.doc").alias("d"), F.col("low.row").alias("r"))
    texts = src.join(reps.hint("shuffle_hash"), (F.col("doc") == F.col("d")) & (F.col("row") == F.col("r")))
    sets = texts.select("k", "t").mapInArrow(lean(_sets(k)), "doc long, shingles binary").dropDuplicates(["doc"])
    member = found.withColumnRenamed("node", "doc").join(sets, "doc").join(classes.select("doc", "size"), "doc").checkpoint()
    units = (block_pairs(member, "component", "doc", block).groupBy("component", "lo", "hi")
             .agg(F.collect_list(F.struct("doc", "mine", "size", "shingles")).alias("rows")).select("lo", "hi", "rows"))
    checked = units.mapInArrow(lean(_verified(threshold)), "a long, b long, links long").checkpoint()
    release(spark)
    counts = checked.where("b IS NULL").groupBy(F.col("a").alias("doc")).agg(F.sum("links").alias("links"))
    found = components(checked.where("b IS NOT NULL")).checkpoint()
    per_class = (classes.select("doc", "c1", "c2", "low", "size").join(found.withColumnRenamed("node", "doc"), "doc", "left")
                 .join(counts, "doc", "left").withColumn("component", F.coalesce("component", "doc"))).checkpoint()
    release(spark)
    lowest = per_class.groupBy("component").agg(F.min("low").alias("least"))
    per_class = (per_class.join(lowest, "component")
                 .select(F.col("c1").alias("k1"), F.col("c2").alias("k2"), F.col("low.doc").alias("class_id"), "size", "least", F.coalesce("links", F.lit(0)).alias("links")))
    worded = (ids.where("n > 0").join(per_class, (F.col("c1") == F.col("k1")) & (F.col("c2") == F.col("k2")))
              .select("doc", "row", "class_id", (F.col("links") + F.col("size") - 1).alias("n_links"), F.col("least.doc").alias("group_id"),
                      (F.struct("doc", "row") == F.col("least")).alias("kept")))
    empty = ids.where("n = 0").select("doc", "row", F.col("doc").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("doc").alias("group_id"), F.lit(True).alias("kept"))
    out = worded.union(empty)
    return out.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias(doc_id), "row", "class_id", "n_links", "group_id", "kept")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each group, with all columns of ``docs``."""
    own = []
    for c in ("_doc", "_row", "_k", "_r"):
        own.append(free_name([*docs.columns, *own], c))
    doc, row, key, digest = own
    r = near_duplicates(docs, doc_id, text, **options).where("kept").select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias(key), F.col("row").alias(digest))
    d = docs.withColumns({doc: F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)), row: F.xxhash64(F.coalesce(F.col(text), F.lit("")))})
    d = d.join(r.hint("shuffle_hash"), (F.col(doc) == F.col(key)) & (F.col(row) == F.col(digest)), "left_semi")
    return d.dropDuplicates([doc, row]).select(*docs.columns)


def op9(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("row")


OP9_SQL = r"""
WITH RECURSIVE
u AS (SELECT DISTINCT doc_id, coalesce(doc_id, 9223372036854775807) AS doc, coalesce(text, '') AS t FROM documents),
d AS (SELECT row_number() OVER () AS rid, doc_id, doc, regexp_extract_all(
        translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM u),
s AS (
  SELECT DISTINCT rid, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
shared AS (SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.rid <> b.rid GROUP BY 1, 2),
link AS (SELECT x, y, c = p.n AND c = q.n AS same FROM shared JOIN n p ON p.rid = x JOIN n q ON q.rid = y WHERE c / (p.n + q.n - c)::DOUBLE >= 0.8),
reach AS (SELECT rid AS a, rid AS b FROM d UNION SELECT a, y FROM reach JOIN link ON b = x),
comp AS (SELECT a AS rid, min(doc) AS least FROM reach JOIN d ON d.rid = b GROUP BY a),
class AS (SELECT x AS rid, min(doc) AS least FROM link JOIN d ON d.rid = y WHERE same GROUP BY x),
links AS (SELECT x AS rid, count(*) AS n_links FROM link GROUP BY x)
SELECT doc_id, nullif(least(doc, coalesce(class.least, doc)), 9223372036854775807) AS class_id, coalesce(n_links, 0) AS n_links,
       nullif(comp.least, 9223372036854775807) AS group_id, doc = comp.least AS kept
FROM d JOIN comp USING (rid) LEFT JOIN class USING (rid) LEFT JOIN links USING (rid)
"""
