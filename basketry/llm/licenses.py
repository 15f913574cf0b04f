r"""License scans (operator 2) by diagonal voting, in DataFrame functions only.

Every text becomes its words; all rolling 2-grams are hashed and joined with
the positions of the same 2-grams in the license templates (a fixed list, so
the broadcast is bounded).  A match votes for a diagonal: word position minus
template position.  Votes are aggregated by (document, template, diagonal) as
a bit set of covered template positions; neighbouring diagonals of a long
template merge (words inserted or missing in between).  A merged span is verified
around its strongest diagonal: of the diagonals at most ``DRIFT`` away from it, the
template's 2-grams (by words, not only hashes) count as far as their first places
follow each other in the template's order, and their share must reach ``COVER``.
Base phrases need all their 2-grams on one diagonal.

The words of the text are those of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after
A-Z have been lower-cased.  ``lower`` would also turn the Kelvin sign into k,
so that sign is replaced by another letter first.  A dotted capital I becomes an
ASCII i and a mark that stays in the word, so no other word becomes one of ASCII
alone, and positions never change.

Defined results: null text is empty, with n_words 0 and null positions; rows
that repeat both doc_id and text give one row; rows that share only doc_id
give a row each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import table

#: Base phrases and their labels.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
#: The method's own templates (sentences of public licenses) and labels.
TEMPLATES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("licensed under a creative commons attribution", "cc"),
    ("licensed under cc by", "cc"),
    ("spdx license identifier", "spdx"),
    ("all rights reserved", "proprietary"),
]
#: Diagonals of a long template at most this far apart merge.
GAP = 3
#: Words by which a span may drift from its strongest diagonal.
DRIFT = 8
#: Share of a template's 2-grams that verifies a span.
COVER = 0.8
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def grams(base, templates) -> list[tuple]:
    """(template, label, is base, number of 2-grams, position, word, next word)."""
    out = []
    for t, (text, label, is_base) in enumerate([(*b, True) for b in base] + [(*x, False) for x in templates]):
        w = text.split()
        if not 2 <= len(w) <= 63:
            raise ValueError("a template has 2 to 63 words")
        out += [(t, label, is_base, len(w) - 1, p, w[p], w[p + 1]) for p in range(len(w) - 1)]
    return out


def _values(rows) -> str:
    q = lambda x: str(x).lower() if isinstance(x, bool) else str(x) if isinstance(x, int) else "'" + x.replace("'", "") + "'"
    return ", ".join("(" + ", ".join(map(q, r)) + ")" for r in rows)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", base=None, templates=None,
         gap: int = GAP, cover: float = COVER) -> DataFrame:
    """One row per (template, verified span): doc_id, text hash, n_words, label,
    is_base, start and end word, coverage; and one row per document whose label
    is null, so that documents without spans are there too."""
    spark = docs.sparkSession
    rows = grams(BASE if base is None else base, TEMPLATES if templates is None else templates)
    # the row of template -1 meets the last word of every document: one row per document
    templates_df = spark.sql(f"""SELECT *, xxhash64(w0, w1) AS h FROM VALUES {_values(rows)} AS t(tid, label, is_base, size, tpos, w0, w1)
                                 UNION ALL SELECT -1, NULL, false, 0, 0, NULL, NULL, xxhash64('', '')""")
    low = F.lower(F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("K"), F.lit("ĸ")))
    w = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("key"),
                    F.array_remove(F.split(low, SEPARATORS), "").alias("words"))
    g = (w.select("doc", "key", "words", F.posexplode_outer("words").alias("pos", "a"))
         .select("doc", "key", F.size("words").alias("n"), "pos", "a", F.get("words", F.col("pos") + 1).alias("b"))
         .withColumn("h", F.when(F.col("b").isNull(), F.xxhash64(F.lit(""), F.lit(""))).otherwise(F.xxhash64("a", "b"))))
    votes = (g.join(F.broadcast(templates_df), "h")
             .where("CASE WHEN b IS NULL THEN tid = -1 ELSE a = w0 AND b = w1 END")
             .groupBy("doc", "key", "n", "tid", "label", "is_base", "size", (F.coalesce(F.col("pos"), F.lit(0)) - F.col("tpos")).alias("diagonal"))
             .agg(F.expr("bit_or(shiftleft(1L, tpos))").alias("seen")))
    votes = votes.withColumn("diagonal", F.when(F.col("tid") >= 0, F.col("diagonal")))
    merged = votes.selectExpr("*", f"""CASE WHEN is_base OR diagonal - lag(diagonal) OVER (PARTITION BY doc, key, tid ORDER BY diagonal) > {gap}
                                       THEN 1 ELSE 0 END AS new""")
    merged = merged.selectExpr("*", "sum(new) OVER (PARTITION BY doc, key, tid ORDER BY diagonal) AS span")
    span = "OVER (PARTITION BY doc, key, tid, span)"
    merged = merged.selectExpr("*", f"bit_count(bit_or(seen) {span}) AS found", f"max(bit_count(seen)) {span} AS best")
    # one diagonal each (plain): documents, and base phrases that stand there whole; of the
    # others the 2-grams near the strongest diagonal, as far as they follow each other
    merged = merged.selectExpr("*", f"min(CASE WHEN bit_count(seen) = best THEN diagonal END) {span} AS anchor",
                               "label IS NULL OR is_base AND found = size AS plain")
    near = merged.where(F.col("plain") | ~F.col("is_base") & (F.col("found") >= cover * F.col("size")) & (F.abs(F.col("diagonal") - F.col("anchor")) <= DRIFT))
    spots = near.selectExpr("*", "explode(CASE WHEN plain THEN array(0) ELSE filter(sequence(0, size - 1), t -> shiftright(seen, t) & 1 = 1) END) AS t")
    keys = ["doc", "key", "n", "tid", "label", "is_base", "size", "span", "plain"]
    spots = spots.groupBy(*keys, "t").agg(F.min(F.col("diagonal") + F.col("t")).alias("pos"))
    spots = spots.selectExpr("*", "max(pos) OVER (PARTITION BY doc, key, tid, span ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before")
    spans = (spots.where("before IS NULL OR pos > before").groupBy(*keys)
             .agg(F.min("pos").alias("start"), F.max("pos").alias("last"), F.count(F.lit(1)).alias("m")))
    spans = spans.selectExpr("*", "CASE WHEN plain THEN 1.0D ELSE m / size END AS coverage", "CASE WHEN plain THEN start + size + 1 ELSE last + 2 END AS end")
    return spans.where(F.col("coverage") >= cover).select(
        F.col("doc").alias(doc_id), "key", F.col("n").cast("long").alias("n_words"), "label", "is_base",
        F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "coverage")


def summary(spans: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row per document of the spans of :func:`scan`."""
    names = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    base = F.when(F.col("is_base"), F.col("start"))
    return (spans.groupBy(doc_id, "key", "n_words")
            .agg(F.count(base).alias("n_base"), F.min(base).alias("first_word"), F.max(base).alias("last_word"),
                 names(F.when(F.col("is_base"), F.col("label"))).alias("base_labels"), names("label").alias("labels"),
                 F.coalesce(F.max(F.when(F.col("label").isNotNull(), F.col("coverage"))), F.lit(0.0)).alias("score"))
            .drop("key"))


def op2(spark, sf_dir: str) -> DataFrame:
    return summary(scan(table(spark, sf_dir, "documents")))


OP2_SQL = rf"""
WITH templates(tid, label, is_base, size, tpos, w0, w1) AS (VALUES {_values(grams(BASE, TEMPLATES))}),
lowered AS (SELECT DISTINCT doc_id, text, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
numbered AS (SELECT *, row_number() OVER () AS d FROM lowered),
pairs AS (SELECT d, unnest(range(0, len(w) - 1)) AS pos, unnest(w[1:len(w) - 1]) AS a, unnest(w[2:]) AS b FROM numbered WHERE len(w) > 1),
votes AS (SELECT d, tid, label, is_base, size, pos - tpos AS diagonal, bit_or(CAST(1 AS BIGINT) << tpos) AS seen
          FROM pairs JOIN templates ON a = w0 AND b = w1 GROUP BY ALL),
marked AS (SELECT *, CASE WHEN is_base OR diagonal - lag(diagonal) OVER (PARTITION BY d, tid ORDER BY diagonal) > {GAP} THEN 1 ELSE 0 END AS new FROM votes),
numbered_spans AS (SELECT *, sum(new) OVER (PARTITION BY d, tid ORDER BY diagonal) AS span FROM marked),
measured AS (SELECT *, bit_count(bit_or(seen) OVER w) AS found, max(bit_count(seen)) OVER w AS best FROM numbered_spans WINDOW w AS (PARTITION BY d, tid, span)),
near AS (SELECT *, min(CASE WHEN bit_count(seen) = best THEN diagonal END) OVER (PARTITION BY d, tid, span) AS anchor
         FROM measured WHERE NOT is_base AND found >= {COVER} * size),
spots AS (SELECT d, tid, label, size, span, t, min(diagonal + t) AS pos
          FROM (SELECT *, unnest(range(0, size)) AS t FROM near WHERE abs(diagonal - anchor) <= {DRIFT}) x
          WHERE (seen >> t) & 1 = 1 GROUP BY ALL),
ordered AS (SELECT *, max(pos) OVER (PARTITION BY d, tid, span ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM spots),
good AS (
  SELECT d, label, true AS is_base, diagonal AS first, 1.0::DOUBLE AS coverage FROM measured WHERE is_base AND found = size
  UNION ALL
  SELECT d, label, false, min(pos), count(*) / CAST(size AS DOUBLE) FROM ordered WHERE before IS NULL OR pos > before
  GROUP BY d, tid, label, size, span HAVING count(*) >= {COVER} * size),
told AS (SELECT d, count(*) FILTER (WHERE is_base) AS n_base, min(first) FILTER (WHERE is_base) AS first_word, max(first) FILTER (WHERE is_base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE is_base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
         max(coverage) AS score FROM good GROUP BY d)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM numbered LEFT JOIN told USING (d)
"""
