"""Corpus pipeline: five stages over ``documents``, each one operator of
basketry.llm.

language_id         documents that the calibrated language model rejects go
near_duplicates     one document of each group of near duplicates stays
repeated_passages   bytes of 50-byte strings that an earlier document holds
                    are cut out of the text (characters only as a whole)
contamination       documents that the benchmark contaminates go
mixing              what the weighted mix takes of every document left

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, with the
columns of ``docs`` in all stages but the last; ``run`` writes each stage's
rows as Parquet under ``spark.checkpoint.dir`` and reads them back as the next
stage's documents, so a lost executor costs a stage's tasks at most.

Defined results: null text has no letter, so the language stage rejects it;
what is empty after cutting stays, as a document of no words; null doc_id
counts as the largest id; of rows that repeat doc_id and text one stays; empty
tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry.llm import decontaminate, langid, mixing, neardup, suffixes
from basketry.llm.common import free_name, release, ship, table
from basketry.session import run_dir


def language_id(spark, docs, sf_dir):
    """Trains on the labelled rows of ``docs`` (a bounded sample of them)."""
    ship(spark)
    model = langid.train(docs, F.lit(True))
    judged = langid.identify(docs, model)
    return judged.where(~F.col(judged.columns[-1])).select(*docs.columns)


def near_duplicates(spark, docs, sf_dir):
    ship(spark)
    return neardup.keep_one(docs)


def repeated_passages(spark, docs, sf_dir):
    ship(spark)
    cut = suffixes.remove_repeats(docs, whole_chars=True)
    kept = cut.columns[-1]
    cut = cut.withColumn("text", F.col(kept).cast("string"))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def contamination(spark, docs, sf_dir):
    ship(spark)
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    n_words, n_hit = found.columns[-4:-2]
    return found.where(~decontaminate.contaminated(F.col(n_hit), F.col(n_words))).select(*docs.columns)


def mixed(spark, docs, sf_dir):
    """The documents with size, source_size, target and taken (words that the mix takes, repeats counted)."""
    ship(spark)
    m = mixing.per_document(mixing.mix(docs))
    names = []
    for c in ("size", "source_size", "target", "taken"):
        names.append(free_name([*docs.columns, *names], c))
    own = []
    for c in ("_id", "_row", "_text_row"):
        own.append(free_name([*docs.columns, *names, *own], c))
    key, row, mine = own
    m = m.dropDuplicates(["doc_id", "row"]).select(F.col("doc_id").alias(key), F.col("row").alias(row), *(F.col(c).alias(n) for c, n in zip(("size", "source_size", "target", "taken"), names, strict=True)))
    d = docs.withColumn(mine, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    return d.join(m, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(mine) == F.col(row))).select(*docs.columns, *names)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("contamination", contamination),
    ("mixing", mixed),
]

#: The stages hold models and multi-pass searches that SQL cannot express.
ORACLE_SQL = None


def run(spark, sf_dir: str):
    docs = table(spark, sf_dir, "documents")
    root = run_dir(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        out = f"{root}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        release(spark)
        docs = spark.read.parquet(out)
    return docs
