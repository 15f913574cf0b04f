"""Embedding near-dedup (operator 3): NN-descent over cosine similarity.

1. Equal vectors form classes, numbered; from here on a class is one vector.
2. First graph: in each of ``TABLES`` tables the vectors are sorted by the
   signs of random projections and cut into blocks; every vector takes its
   ``K`` nearest of its blocks.
3. NN-descent: a vector's neighbours and reverse neighbours meet in a join and
   are compared with each other; every vector keeps its K nearest.  Rounds go
   on until few lists change, ``ROUNDS`` at most; the audit makes up for what they
   leave.  A reverse list is sampled (by a hash) to ``2 * K``, as the method has it;
   step 5 makes up for that.
4. Edges at or above the threshold give components.  Of all pairs met in steps
   2 and 3 at or above the threshold, also beyond a full list, a spanning
   forest of each block or meeting is passed on.
5. Saturated lists (K neighbours, all at or above the threshold) may end before
   a link to another component.  Their vectors search on, by tables and a
   descent of their own, for their K nearest *outside* their component; links
   found so join components, and the search is repeated until it finds none.
   Inside every component all members are then compared in blocks, in double
   precision, and counted; pairs are not emitted.
6. Audit: for a bounded sample of query vectors of every class of component
   sizes the links are counted by brute force over all vectors.  Recall is
   averaged over query vectors, for each class of true link counts.  While one
   is below ``RECALL``, K is doubled, new tables with other projections join
   the graph and the descent goes on; after ``AUDITS`` rounds it is an error.

Defined results: null vectors, zero vectors and vectors with null or
non-finite components link with nothing; so do vectors of different lengths.
Rows that repeat vec_id and vector are one vector; a vec_id with several vectors
gets one row with the sum of their links, and they share a component.  Rows
without a vec_id are vectors of their own and get a row each, with the smallest
vec_id of their component or null.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import release, shuffle_partitions, table
from basketry.llm.graph import block_pairs, components
from basketry.llm.neardup import forest
from basketry.session import checkpoint_root

THRESHOLD = 0.95
K = 10
TABLES = 6
BITS = 24
SORTED_BLOCK = 64
ROUNDS = 6
#: A descent ends when fewer than this share of all list entries is new.
CHANGE = 0.002
#: Query vectors of the audit, about, for each power of two of component sizes, and what it must reach.
AUDIT = 100
RECALL = 0.99
AUDITS = 4
BLOCK = 256
#: Similarities this near to the threshold are decided in double precision.
CLOSE = 1e-9
EDGES = "a long, b long"


def _valid(col: str):
    v = F.col(col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v, F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _codes(v: np.ndarray, tables: range) -> list[np.ndarray]:
    out = []
    for t in tables:
        plane = np.random.default_rng([v.shape[1], t]).standard_normal((v.shape[1], BITS))
        out.append(((v @ plane) > 0).astype(np.int64) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)))
    return out


def _matrix(col) -> np.ndarray:
    """Rows of equal length, from a binary column."""
    return np.frombuffer(b"".join(col), "<f8").reshape(len(col), -1)


def unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(1, keepdims=True)  # no overflow in the squares
    return v / np.sqrt(np.square(v).sum(1, keepdims=True))


def _nearest(ids: np.ndarray, group: np.ndarray, v: np.ndarray, floor: np.ndarray | None, k: int, threshold: float, new: np.ndarray | None = None):
    """(a, b, similarity): for each member its k nearest of the other groups, above its floor, and a
    spanning forest of all pairs at the threshold; with ``new``, only pairs of which one is new."""
    s = v @ v.T
    same = group[:, None] == group[None, :]
    s[same] = -2
    k = min(k, len(ids) - 1)
    if k < 1:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0)
    cut = np.partition(s, len(ids) - k, axis=1)[:, len(ids) - k]
    cut = np.maximum(cut, floor) if floor is not None else cut
    may = ~same if new is None else ~same & (new[:, None] | new[None, :])
    near = (s >= cut[:, None]) & may
    more = (s >= threshold - CLOSE) & may & ~(near | near.T)
    if more.any():
        every = np.arange(len(ids))
        for x, y in forest(more, every, every, len(ids)):
            near[x, y] = True
    i, j = np.nonzero(near)
    return ids[i], ids[j], s[i, j]


def _table_pairs(block: int, k: int, threshold: float):
    """Neighbours within blocks of consecutive rows of one sorted partition."""
    def run(batches):
        ids, vecs, groups = [], [], []

        def flush():
            a, b, s = _nearest(np.array(ids), np.array(groups), unit(_matrix(vecs)), None, k, threshold)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s)], ["a", "b", "s"])

        for batch in batches:
            for i, v, g in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                if len(ids) == block or (vecs and len(v) != len(vecs[0])):
                    yield flush()
                    ids, vecs, groups = [], [], []
                ids.append(i)
                vecs.append(v)
                groups.append(g)
        if ids:
            yield flush()
    return run


def _add_codes(tables: range):
    names = [f"t{t}" for t in tables]

    def run(batches):
        for b in batches:
            codes = [np.zeros(b.num_rows, np.int64) for _ in names]
            raw = b.column(1).to_pylist()
            size = np.array([len(x) for x in raw])
            for z in np.unique(size):
                on = np.flatnonzero(size == z)
                for c, got in zip(codes, _codes(unit(_matrix([raw[i] for i in on])), tables), strict=True):
                    c[on] = got
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), *(pa.array(c) for c in codes)], ["id", "v", "g", *names])
    return run


def _from_tables(vecs: DataFrame, total: int, tables: range, k: int, threshold: float, most: int | None = None) -> DataFrame:
    """Pairs of different groups from the blocks of the tables; vecs: id, v, g (group).

    With ``most``, a table holds about that many members of each group, others in every table, so
    that a block holds several groups."""
    sizes = vecs.groupBy("g").agg(F.count(F.lit(1)).alias("m"))
    coded = vecs.select("id", "v", "g").mapInArrow(_add_codes(tables), "id long, v binary, g long, " + ", ".join(f"t{t} long" for t in tables))
    # a partition holds many blocks, so that few neighbours are parted at its ends
    n = max(1, min(shuffle_partitions(vecs.sparkSession), total // (8 * SORTED_BLOCK)))
    out = None
    for t in tables:
        s = coded if most is None else coded.join(sizes, "g").where(F.pmod(F.xxhash64("id", F.lit(t)), F.col("m")) < most)
        s = s.select("id", "v", "g", F.octet_length("v").alias("z"), f"t{t}").repartitionByRange(n, "z", f"t{t}", "id").sortWithinPartitions("z", f"t{t}", "id")
        s = s.select("id", "v", "g").mapInArrow(_table_pairs(SORTED_BLOCK, k, threshold), "a long, b long, s double")
        out = s if out is None else out.union(s)
    return out


def _lists(pairs: DataFrame, k: int) -> DataFrame:
    """(u, near): the k nearest of each vector, best first; ties by id.  An entry
    is (s, b, old), old if one of its ``pairs`` is marked so."""
    old = F.col("old") if "old" in pairs.columns else F.lit(False)
    one = pairs.groupBy(F.col("a").alias("u"), "b").agg(F.max("s").alias("s"), F.max(old).alias("old"))
    return one.groupBy("u").agg(F.slice(F.sort_array(F.collect_list(F.struct("s", "b", "old")), asc=False), 1, k).alias("near"))


def _meeting(k: int, threshold: float):
    """Neighbours of one vector compared with each other."""
    def run(batches):
        for b in batches:
            out = ([], [], [])
            for rows in b.column(0).to_pylist():
                if len(rows) < 2:
                    continue
                ids = np.array([r["id"] for r in rows])
                v = _matrix([r["v"] for r in rows])
                floor = np.array([r["floor"] for r in rows])
                new = np.array([r["fresh"] for r in rows])
                group = np.array([r["g"] for r in rows])
                for o, c in zip(out, _nearest(ids, group, v, floor + 1e-12, k, threshold, new), strict=True):
                    o.append(c)
            cat = [np.concatenate(o) if o else np.zeros(0) for o in out]
            yield pa.RecordBatch.from_arrays([pa.array(cat[0].astype(np.int64)), pa.array(cat[1].astype(np.int64)), pa.array(cat[2].astype(float))], ["a", "b", "s"])
    return run


def _descend(vecs: DataFrame, graph: DataFrame, k: int, threshold: float, rounds: int, inside: DataFrame | None = None):
    """NN-descent rounds from a graph (u, near): the last graph, and edges for all pairs met at the threshold.

    Vectors in ``vecs`` (id, v, g) have unit length; pairs of one group g are not listed, but
    ``inside`` (u, w), if given, are edges of the groups that lead to neighbours as well."""
    n, hot = graph.count(), None
    for turn in range(rounds):
        edges = graph.select("u", F.explode("near").alias("e")).select("u", F.col("e.b").alias("w"), (~F.col("e.old")).alias("fresh"))
        if inside is not None:
            edges = edges.union(inside.select("u", "w", F.lit(turn == 0).alias("fresh")))
        back = edges.select(F.col("w").alias("u"), F.col("u").alias("w"), "fresh")
        # reverse neighbours: 2 * k of each vector, by a hash
        back = back.groupBy("u").agg(F.slice(F.sort_array(F.collect_set(F.struct(F.xxhash64("u", "w").alias("h"), "w", "fresh"))), 1, 2 * k).alias("r"))
        back = back.select("u", F.explode("r").alias("r")).select("u", "r.w", "r.fresh")
        floor = graph.select(F.col("u").alias("id"), F.when(F.size("near") >= k, F.element_at("near", -1)["s"]).otherwise(F.lit(-2.0)).alias("floor"))
        info = vecs.join(floor, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(-2.0)))
        both = edges.union(back).groupBy("u", "w").agg(F.max("fresh").alias("fresh"))
        met = (both.join(info, F.col("w") == F.col("id")).groupBy("u")
               .agg(F.collect_list(F.struct("id", "v", "g", "floor", "fresh")).alias("rows")).select("rows")
               .mapInArrow(_meeting(k, threshold), "a long, b long, s double")).checkpoint()
        beyond = met.where(F.col("s") >= threshold - CLOSE).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "s").dropDuplicates(["a", "b"]).checkpoint()
        hot = beyond if hot is None else hot.union(beyond)
        # the next lists tell which of their entries the last ones had
        old = _entries(graph).withColumn("old", F.lit(True))
        graph = _lists(old.union(met.withColumn("old", F.lit(False))), k).checkpoint()
        fresh = graph.agg(F.sum(F.size(F.filter("near", lambda e: ~e["old"])))).first()[0] or 0
        release(vecs.sparkSession)
        if fresh < CHANGE * n * k:
            break
    return graph, hot


def _entries(graph: DataFrame) -> DataFrame:
    return graph.select(F.col("u").alias("a"), F.explode("near").alias("e")).select("a", "e.b", "e.s")


def _true_links(pairs: DataFrame, vecs: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b, s) at or above the threshold as edges a < b."""
    edges = pairs.where(F.col("s") >= threshold + CLOSE).select("a", "b")
    close = pairs.where(F.abs(F.col("s") - threshold) < CLOSE).select("a", "b").distinct()
    close = close.join(vecs.select(F.col("id").alias("a"), F.col("v").alias("x")), "a").join(vecs.select(F.col("id").alias("b"), F.col("v").alias("y")), "b")
    edges = edges.union(close.select("a", "b", "x", "y").mapInArrow(_exact(threshold), EDGES))
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _join_components(units: DataFrame, vecs: DataFrame, graph: DataFrame, links: DataFrame, found: DataFrame, k: int, threshold: float):
    """(links, found) after the search of saturated vectors outside their components.

    A link of a vector whose list ends below the threshold is in that list, so only links between
    two saturated vectors can be missing.  Every turn joins components; the last one finds nothing."""
    full = graph.where((F.size("near") >= k) & (F.element_at("near", -1)["s"] >= threshold - CLOSE)).select(F.col("u").alias("id")).checkpoint()
    total = full.count()
    if not total:
        return links, found
    mine = units.select("id", "v").join(full, "id").checkpoint()
    inside = (_entries(graph).select(F.col("a").alias("u"), F.col("b").alias("w")).join(full.withColumnRenamed("id", "u"), "u")
              .join(full.withColumnRenamed("id", "w"), "w").select("u", "w").checkpoint())
    old, turn = None, 0
    while True:
        grouped = mine.join(found.select(F.col("node").alias("id"), F.col("component").alias("g")), "id").select("id", "v", "g").checkpoint()
        if grouped.select("g").distinct().limit(2).count() < 2:
            return links, found
        start = 1_000_000 + turn * TABLES  # other projections than those of the first graph
        pairs = _from_tables(grouped, total, range(start, start + TABLES), k, threshold, 2 * k)
        if old is not None:
            group = grouped.select("id", "g")
            old = old.join(group.toDF("a", "g"), "a").join(group.toDF("b", "h"), "b").where("g != h").select("a", "b", "s")
            pairs = pairs.union(old)
        pairs = pairs.checkpoint()
        lists, hot = _descend(grouped, _lists(pairs, k).checkpoint(), k, threshold, ROUNDS, inside)
        old = _entries(lists)
        new = _true_links(pairs.union(old).union(hot), vecs, threshold).checkpoint()
        if new.isEmpty():
            return links, found
        links = links.union(new)
        found = components(links).checkpoint()
        turn += 1


def _count_links(threshold: float):
    def run(batches):
        for b in batches:
            ids, links = [], []
            for lo, hi, rows in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                mine, size = np.array([r["mine"] for r in rows]), np.array([r["size"] for r in rows], np.int64)
                x, raw = np.array([r["id"] for r in rows], np.int64), [r["v"] for r in rows]
                left, right = np.flatnonzero(mine == lo), np.flatnonzero(mine == hi)
                ok = linked_raw([raw[i] for i in left], [raw[i] for i in right], threshold)
                if lo == hi:
                    np.fill_diagonal(ok, False)
                    ids.extend(x[left].tolist())
                    links.extend((ok @ size[right]).tolist())
                else:
                    ids.extend(x[left].tolist() + x[right].tolist())
                    links.extend((ok @ size[right]).tolist() + (size[left] @ ok).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(links, pa.int64())], ["id", "links"])
    return run


def linked(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of rows reach the threshold, by dot product over norms in double precision."""
    na, nb = np.sqrt(np.square(a).sum(1)), np.sqrt(np.square(b).sum(1))
    bad = ~(np.isfinite(na) & (na > 0)), ~(np.isfinite(nb) & (nb > 0))
    if bad[0].any() or bad[1].any():  # squares over- or underflow: scaled first
        return unit(a) @ unit(b).T >= threshold
    return a @ b.T / (na[:, None] * nb[None, :]) >= threshold


def linked_raw(a: list[bytes], b: list[bytes], threshold: float) -> np.ndarray:
    """:func:`linked` of packed vectors; those of different lengths (which only a
    shared vec_id brings together) link with nothing."""
    out = np.zeros((len(a), len(b)), bool)
    wide_a, wide_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    for z in np.intersect1d(wide_a, wide_b):
        i, j = np.flatnonzero(wide_a == z), np.flatnonzero(wide_b == z)
        out[np.ix_(i, j)] = linked(_matrix([a[k] for k in i]), _matrix([b[k] for k in j]), threshold)
    return out


def _audit(vecs: DataFrame, found: DataFrame, counts: DataFrame, threshold: float) -> float:
    """The least recall of a class of query vectors (by the power of two of their true links)."""
    sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("m"))
    kinds = found.join(sizes, "component").select(F.col("node").alias("id"), F.floor(F.log2("m")).cast("int").alias("kind"))
    rows = vecs.select("id", "v").join(kinds, "id", "left").withColumn("kind", F.coalesce("kind", F.lit(0)))
    weight = {r.kind: max(1.0, r.n / AUDIT) for r in rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not weight:
        return 1.0
    top = F.coalesce(*(F.when(F.col("kind") == k, F.lit(int((2.0**63 - 1024) / w))) for k, w in weight.items()))
    picked = rows.where(F.abs(F.xxhash64("id", F.lit(17))) <= top)
    rows = picked.join(counts, "id", "left").select("id", "v", "kind", F.coalesce("links", F.lit(0)).alias("links")).collect()
    queries = {}
    for r in rows:
        queries.setdefault(len(r.v), []).append((r.id, bytes(r.v)))
    bc = vecs.sparkSession.sparkContext.broadcast(queries)

    def run(batches):
        for b in batches:
            ids, raw, size = b.column(0).to_numpy(), b.column(1).to_pylist(), b.column(2).to_numpy()
            width, out = np.array([len(x) for x in raw]), []
            for z, mine in bc.value.items():
                on = np.flatnonzero(width == z)
                if not len(on):
                    continue
                q = np.array([x[0] for x in mine])
                ok = linked(_matrix([x[1] for x in mine]), _matrix([raw[i] for i in on]), threshold) & (q[:, None] != ids[on][None, :])
                out += zip(q.tolist(), (ok @ size[on]).tolist(), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["id", "n"])

    true = {r.id: r.n for r in vecs.select("id", "v", "size").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()}
    return recall((r.links, true.get(r.id, 0), weight[r.kind]) for r in rows)


def recall(queries) -> float:
    """The least of the weighted mean recalls of the classes of query vectors (found, true, weight)."""
    got, want = {}, {}
    for links, true, w in queries:
        if true:
            c = int(true).bit_length()
            got[c] = got.get(c, 0.0) + w * min(links, true) / true
            want[c] = want.get(c, 0.0) + w
    return min((got[c] / want[c] for c in want), default=1.0)


def _units(vecs: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([unit(_matrix([x]))[0].tobytes() for x in b.column(1).to_pylist()], pa.binary())], ["id", "v"])
    return vecs.select("id", "v").mapInArrow(run, "id long, v binary").withColumn("g", F.col("id"))


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD, k: int = K) -> DataFrame:
    """One row per vec_id, and one per vector without one: n_links, component_id, kept."""
    checkpoint_root(vectors.sparkSession)
    v, fine = _valid(embedding)
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.when(fine, v).alias("x"))
    # k: rows of one id and vector; they are one vector, unless the id is null
    rows = rows.groupBy("id", "x").agg(F.count(F.lit(1)).alias("k")).checkpoint()

    def raw(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([np.asarray(x, "<f8").tobytes() for x in b.column(1).to_pylist()], pa.binary()), b.column(2)], ["vec", "v", "k"])

    member = rows.where("x IS NOT NULL").mapInArrow(raw, "vec long, v binary, k long")
    classes = member.groupBy("v").agg(F.min("vec").alias("low"), F.sum(F.when(F.col("vec").isNull(), F.col("k")).otherwise(1)).alias("size"))
    vecs = classes.withColumn("id", F.monotonically_increasing_id()).select("id", "v", "size", "low").checkpoint()
    # classes that share a vec_id belong together
    owned = member.where("vec IS NOT NULL").join(vecs.select("v", "id"), "v").select("vec", "id")
    shared = owned.groupBy("vec").agg(F.min("id").alias("a"), F.max("id").alias("top")).where("a != top").select("vec", "a")
    shared = owned.join(shared, "vec").where("id != a").select("a", F.col("id").alias("b")).checkpoint()
    total = vecs.count()
    units = _units(vecs).checkpoint()
    links, graph, found, counts = None, None, None, None
    for audit in range(AUDITS):
        k = k if audit == 0 else 2 * k
        pairs = _from_tables(vecs.select("id", "v", F.col("id").alias("g")), total, range(audit * TABLES, (audit + 1) * TABLES), k, threshold).checkpoint()
        old = pairs if graph is None else pairs.union(_entries(graph))
        graph, hot = _descend(units, _lists(old, k).checkpoint(), k, threshold, ROUNDS)
        edges = _true_links(_entries(graph).union(pairs).union(hot), vecs, threshold)
        links = edges.union(shared) if links is None else links.union(edges)
        found = components(links).checkpoint()
        links, found = _join_components(units, vecs, graph, links, found, k, threshold)
        m = found.withColumnRenamed("node", "id").join(vecs, "id")
        work = (block_pairs(m, "component", "id", BLOCK).groupBy("component", "lo", "hi").agg(F.collect_list(F.struct("id", "mine", "size", "v")).alias("rows")).select("lo", "hi", "rows"))
        counts = work.mapInArrow(_count_links(threshold), "id long, links long").groupBy("id").agg(F.sum("links").alias("links")).checkpoint()
        reached = _audit(vecs, found, counts, threshold)
        if reached >= RECALL:
            break
    else:
        raise RuntimeError(f"recall of the links is {reached:.4f} after {AUDITS} rounds, below {RECALL}")
    per = (vecs.join(found.withColumnRenamed("node", "id"), "id", "left").join(counts, "id", "left")
           .select("v", "low", F.coalesce("component", "id").alias("c"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links")))
    per = per.join(per.groupBy("c").agg(F.min("low").alias("component_id")), "c").select("v", "n_links", "component_id")
    good = member.join(per, "v")
    ids = rows.where("id IS NOT NULL").select("id").distinct()
    named = good.where("vec IS NOT NULL").groupBy(F.col("vec").alias("id")).agg(F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    named = ids.join(named, "id", "left").select("id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    each = F.explode(F.sequence(F.lit(1), F.col("k").cast("int")))
    no_id = good.where("vec IS NULL").select("n_links", "component_id", each).select(F.lit(None).cast("long").alias("id"), "n_links", "component_id")
    bad = rows.where("id IS NULL AND x IS NULL").select(each).select(F.lit(None).cast("long").alias("id"), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"))
    out = named.union(no_id).union(bad)
    return out.select(F.col("id").alias(vec_id), F.col("n_links").cast("long").alias("n_links"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _exact(threshold: float):
    def run(batches):
        for b in batches:
            ok = pa.array([bool(linked(_matrix([x]), _matrix([y]), threshold)[0, 0]) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(ok), b.column(1).filter(ok)], ["a", "b"])
    return run


def op3(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP3_SQL = r"""
WITH RECURSIVE
one AS (SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL
        UNION ALL SELECT vec_id, embedding::DOUBLE[] FROM embeddings WHERE vec_id IS NULL),
v AS (SELECT row_number() OVER () AS r, vec_id, e FROM one),
valid AS (
  SELECT r, list_transform(e, lambda x: CASE WHEN isfinite(x) THEN x ELSE 0 END) AS e FROM v
  WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
ok AS (SELECT r, e, sqrt(list_dot_product(e, e)) AS norm FROM valid),
link AS (
  SELECT a.r AS x, b.r AS y FROM ok a JOIN ok b ON a.r <> b.r
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_dot_product(a.e, b.e) / (a.norm * b.norm) END >= 0.95),
edge AS (SELECT x, y FROM link UNION SELECT a.r, b.r FROM v a JOIN v b ON a.vec_id = b.vec_id AND a.r <> b.r),
reach AS (SELECT r AS a, r AS b FROM v UNION SELECT a, y FROM reach JOIN edge ON b = x),
low AS (SELECT a AS r, min(vec_id) AS component_id FROM reach JOIN v ON v.r = b GROUP BY a),
n AS (SELECT x AS r, count(*) AS n_links FROM link GROUP BY x)
SELECT any_value(vec_id) AS vec_id, CAST(sum(coalesce(n_links, 0)) AS BIGINT) AS n_links, min(component_id) AS component_id,
       any_value(vec_id) IS NOT DISTINCT FROM min(component_id) AS kept
FROM v JOIN low USING (r) LEFT JOIN n USING (r) GROUP BY coalesce('i' || vec_id, 'r' || r)
"""
