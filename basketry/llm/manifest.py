"""Merkle dataset manifest (operator 12): a tree of sha256 over a table's rows.

A leaf is H (lowercase hex sha256) of a row's fields, each ``-`` if null, else
its UTF-8 byte count, ``:`` and its value.  Inside a group (``lang``) leaves
ascend by id; while several nodes remain, every ``FAN`` consecutive ones become
the H of their digests.  What remains is the group's subroot; the subroots,
ordered by group (null first, bytewise), give the root in the same way.

How it runs, in the JVM alone:

1. One scan of the table makes the leaves (checkpointed: 32 bytes a row).
2. Ranks inside a group without a window over the group: leaves are
   range-partitioned by (group, id, digest), sorted, and numbered inside their
   partition; the sizes of the runs (one row for each partition and group) give
   the offsets.
3. Nested-struct rollup: a rank is a block number (its high digits) and
   ``DEPTH`` digits to the base ``FAN``.  After one shuffle by (group, block) the
   digits are grouped away one after the other, the last one first; each step
   nests its children's structs in order and hashes them.  A block holds at most
   FAN ** DEPTH rows, whatever the size of its group.
4. The blocks' digests, FAN ** DEPTH times fewer, are the next pass's leaves, up
   to one node for each group, and then over the groups.
5. Downwards, each block meets the path of its own node (a union grouped by
   block) and one transform and explode emit its children with their paths, the
   digests left and right of them at each level: no joins.

Defined results: ids that repeat, or are null (before all others), are ordered
by their leaf digests; equal rows are leaves of their own; a null group is a
group; an empty table gives no rows; further columns are not looked at.  A
text's bytes are only hashed where they are, so a long one costs its own length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from basketry.llm.common import crc_mod, table
from basketry.session import checkpoint_root

FAN = 8
DEPTH = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(c: Column) -> Column:
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(*cols: Column) -> Column:
    return F.sha2(F.concat(*(field(c) for c in cols)), 256)


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, nothing else; texts of ASCII alone take the short way."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


# ---------------------------------------------------------------------- ranks

def ranked(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` with ``rank`` (from 0) in ``group`` by ``order``, and the group's
    ``n``.  Equal rows are told apart by their place in ``df``, which must be
    checkpointed."""
    keys = [group, *order, "_tie"]
    placed = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = placed.withColumn("_at", F.monotonically_increasing_id()).drop("_tie").checkpoint()
    part = F.shiftrightunsigned("_at", 33)
    runs = placed.groupBy(group, part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    w = Window.partitionBy(group)
    before = F.sum("_n").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(group, "_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(w).alias("n"))
    out = placed.withColumn("_part", part).join(runs, [group, "_part"])
    return out.withColumn("rank", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def levels(n: Column) -> Column:
    """Levels of hashing over ``n`` nodes: the least h with FAN ** h >= n."""
    return F.when(n <= 1, 0).otherwise(F.length(F.conv((n - 1).cast("string"), 10, FAN)))


# --------------------------------------------------------------------- rollup

def rollup(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """(grp, h, n, rank, hash, *payload) to one row for each (grp, block): the
    nested struct ``node`` of the block, with h and n as they were."""
    digits = [f"d{k}" for k in range(DEPTH)]
    t = nodes.select("grp", "h", "n", F.expr(f"rank div {FAN ** DEPTH}").alias("block"),
                     *(F.expr(f"rank div {FAN ** k} % {FAN}").alias(d) for k, d in enumerate(digits)),
                     F.struct("hash", *payload).alias("node")).repartition("grp", "block")
    for k, d in enumerate(digits):
        kids = F.sort_array(F.collect_list(F.struct(F.col(d).alias("d"), F.col("node"))))
        t = t.groupBy("grp", "block", *digits[k + 1:]).agg(F.max("h").alias("h"), F.max("n").alias("n"), kids.alias("kids"))
        joined = F.array_join(F.transform("kids", lambda x: x["node"]["hash"]), "")
        # a level that holds one node of its group only is no level
        digest = F.when(F.col("h") > k, F.sha2(joined, 256)).otherwise(F.col("kids")[0]["node"]["hash"])
        t = t.withColumn("node", F.struct(digest.alias("hash"), F.col("kids"))).drop("kids")
    return t


def emit(node: Column, path: Column, h: Column, k: int = DEPTH) -> Column:
    """The rows under a node of level ``k`` as an array of (leaf, path); a path
    is the digests left and right of a node, from its own level upwards."""
    if not k:
        return F.array(F.struct(node.alias("leaf"), path.alias("path")))
    side = lambda kids: F.array_join(F.transform(kids, lambda x: x["node"]["hash"]), "")

    def child(kid: Column, i: Column) -> Column:
        kids = node["kids"]
        own = F.struct(side(F.slice(kids, F.lit(1), i)).alias("l"), side(F.slice(kids, i + 2, F.lit(FAN))).alias("r"))
        return emit(kid["node"], F.when(h >= k, F.concat(F.array(own), path)).otherwise(path), h, k - 1)

    return F.flatten(F.transform(node["kids"], child))


def climb(nodes: DataFrame, payload: list[str]) -> list[DataFrame]:
    """Passes of :func:`rollup` until each group is one node."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    passes = []
    while True:
        passes.append(rollup(nodes, payload).checkpoint())
        most = -(-most // FAN ** DEPTH)
        if most <= 1:
            return passes
        nodes = passes[-1].select("grp", F.greatest(F.col("h") - DEPTH, F.lit(0)).alias("h"), "n", F.col("block").alias("rank"), F.col("node.hash").alias("hash"), "block")
        payload = ["block"]


PATH = "array<struct<l:string,r:string>>"


def descend(passes: list[DataFrame], paths: DataFrame, carried: list[str]) -> DataFrame:
    """``paths``: (grp, path, *carried) of each group's top node.  Returns (leaf,
    path, *carried) of every first node."""
    paths = paths.withColumn("block", F.lit(0).cast("long"))
    for k, blocks in reversed(list(enumerate(passes))):
        kind = blocks.schema["node"].dataType
        both = blocks.select("grp", "block", "h", "node", F.lit(None).cast(PATH).alias("path"), *(F.lit(None).cast("string").alias(c) for c in carried)).unionByName(
            paths.select("grp", "block", F.lit(None).cast("int").alias("h"), F.lit(None).cast(kind).alias("node"), "path", *carried))
        met = both.groupBy("grp", "block").agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("h", "node", "path", *carried)))
        rows = met.select("grp", *carried, F.explode(emit(F.col("node"), F.col("path"), F.col("h"))).alias("x"))
        paths = rows.select("grp", *carried, F.col("x.leaf").alias("leaf"), F.col("x.path").alias("path"))
        if k:
            paths = paths.withColumn("block", F.col("leaf.block")).drop("leaf")
    return paths


def manifest(docs: DataFrame, leaf: Column, group: Column, id_col: Column, tampered: Column | None = None) -> DataFrame:
    """One row for each row of ``docs``: id, leaf, subroot, root, path (array of
    l, r from the leaf upwards) and the tampered leaf, null where nothing was
    tampered with."""
    checkpoint_root(docs.sparkSession)
    fake = F.lit(None).cast("string") if tampered is None else tampered
    one = docs.select(F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0")).alias("grp"), id_col.alias("id"), F.unhex(leaf).alias("leaf"), F.unhex(fake).alias("fake")).checkpoint()
    hexed = lambda c: F.lower(F.hex(c))
    leaves = ranked(one, "grp", ["id", "leaf"])
    leaves = leaves.select("grp", "n", levels(F.col("n")).alias("h"), "rank", hexed("leaf").alias("hash"), "id", hexed("fake").alias("fake"))
    passes = climb(leaves.checkpoint(), ["id", "fake"])
    tops = passes[-1].select(F.lit("").alias("all"), F.col("grp").alias("of"), F.col("node.hash").alias("hash")).checkpoint()
    tops = ranked(tops, "all", ["of"]).select(F.col("all").alias("grp"), "n", levels(F.col("n")).alias("h"), "rank", "hash", "of")
    above = climb(tops, ["of"])
    root = above[-1].select("grp", F.array().cast(PATH).alias("path"), F.col("node.hash").alias("root"))
    groups = descend(above, root, ["root"]).select(F.col("leaf.of").alias("grp"), "path", "root", F.col("leaf.hash").alias("subroot"))
    rows = descend(passes, groups, ["root", "subroot"])
    return rows.select(F.col("leaf.id").alias("id"), F.col("leaf.hash").alias("leaf"), "subroot", "root", "path", F.col("leaf.fake").alias("fake"))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["l"], x["r"])), ""), 256)


def fold(path: Column, leaf: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda a, x: F.sha2(F.concat(x["l"], a, x["r"]), 256))


def op12(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    cols = [F.col(c) for c in FIELDS]
    text = F.col("text").cast(T.StringType())
    false = F.when(crc_mod("doc_id", 3) == 0, leaf_digest(*cols[:-1], ascii_lower(text)))
    m = manifest(docs, leaf_digest(*cols), F.col("lang"), F.col("doc_id"), false)
    m = m.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), fold(F.col("path"), F.coalesce("fake", "leaf")).alias("folded_root"))
    return m.withColumn("verified", F.col("folded_root") == F.col("root"))


def _bytes_field(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"


_HEAD = " || ".join(_bytes_field(c) for c in FIELDS[:-1])
_CRC = reduce(lambda s, _: f"list_transform({s}, lambda x: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)", range(8), "[xor(a, b)]") + "[1]"

OP12_SQL = f"""
WITH RECURSIVE
d AS (
  SELECT doc_id, lang, sha256({_HEAD} || {_bytes_field("text")}) AS leaf,
         sha256({_HEAD} || {_bytes_field(f"translate(text, '{UPPER}', '{LOWER}')")}) AS folded,
         xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
                                     lambda a, b: {_CRC})) AS crc
  FROM documents),
r AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, leaf, CASE WHEN doc_id IS NOT NULL AND crc % 3 = 0 THEN folded ELSE leaf END AS given,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY lang) AS n
  FROM d),
node AS (
  SELECT lang, 0 AS level, rank AS i, n, leaf AS hash FROM r
  UNION ALL
  SELECT lang, level + 1, i // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY i)) FROM node WHERE n > 1 GROUP BY lang, level, i // 8, n),
sub AS (SELECT lang, hash AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank, count(*) OVER () AS n FROM node WHERE n = 1),
top AS (
  SELECT 0 AS level, rank AS i, n, subroot AS hash FROM sub
  UNION ALL
  SELECT level + 1, i // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // 8, n),
low AS (
  SELECT lang, level, i, coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM node WHERE n > 1 WINDOW w AS (PARTITION BY lang, level, i // 8 ORDER BY i)),
high AS (
  SELECT level, i, coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM top WHERE n > 1 WINDOW w AS (PARTITION BY level, i // 8 ORDER BY i)),
steps AS (
  SELECT rid, 0 AS part, low.level, l, low.r FROM r JOIN low ON r.lang IS NOT DISTINCT FROM low.lang AND low.i = r.rank // (8 ** low.level)::BIGINT
  UNION ALL
  SELECT rid, 1, high.level, l, high.r FROM r JOIN sub ON r.lang IS NOT DISTINCT FROM sub.lang JOIN high ON high.i = sub.rank // (8 ** high.level)::BIGINT),
path AS (SELECT rid, list([l, r] ORDER BY part, level) AS p FROM steps GROUP BY rid),
f AS (
  SELECT r.doc_id, r.leaf, sub.subroot, (SELECT hash FROM top WHERE n = 1) AS root,
         sha256(coalesce(list_aggregate(list_transform(p, lambda x: x[1] || x[2]), 'string_agg', ''), '')) AS proof_sha256,
         list_reduce(list_prepend([given], coalesce(p, [])), lambda a, x: [sha256(x[1] || a[1] || x[2])])[1] AS folded_root
  FROM r JOIN sub ON r.lang IS NOT DISTINCT FROM sub.lang LEFT JOIN path ON r.rid = path.rid)
SELECT *, folded_root = root AS verified FROM f
"""
