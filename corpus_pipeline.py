"""A corpus run: language ID, near-duplicates, personal data, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; its output is written as Parquet and read again.  All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orchard.llm import bpe, langid, mixing, ngram_join, pii
from orchard.llm.common import fold_remainder, materialize, table
from orchard.llm.queries import vocabulary_path

#: The measure of near_duplicates: shingles of five words, Jaccard >= 4/5.
NEAR_WORDS, NEAR_NUM, NEAR_DEN = 5, 4, 5
#: Documents of a source that source_mixing rounds together, on average.
ROUNDING_ROWS = 50_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; rejected ones go."""
    held_out = F.coalesce(fold_remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return docs.where(~langid.rejects(docs, held_out))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked documents.
    Rows without an id stay; rows that share an id stay or go together."""
    groups = ngram_join.jaccard_components(docs, NEAR_WORDS, NEAR_NUM, NEAR_DEN)
    gone = groups.where(F.col("component_id") < F.col("doc_id")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal data in its text replaced by its kind."""
    return pii.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: whole passes over its words,
    and one more for as many documents as the rests of a part of its source add
    up to (systematic rounding).  A part's documents are ordered by size, so the
    words kept differ from the words taken by about one document's.  Rows that
    share an id share the decision."""
    ids = mixing.mix_sources(docs).groupBy("doc_id").agg(F.min("source").alias("source"), F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    ids = materialize(ids.where("taken > 0").withColumn("share", F.col("taken") / F.col("size")), "pipeline-taken")
    parts = ids.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / F.lit(ROUNDING_ROWS)).alias("parts")).select(F.col("source").alias("of"), "parts")
    dealt = ids.join(parts, F.col("source").eqNullSafe(F.col("of"))).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(77)), F.col("parts")))
    line = Window.partitionBy("source", "part").orderBy(F.desc("size"), F.xxhash64("doc_id", F.lit(78)), "doc_id")
    upto = F.sum(F.col("share") - F.floor("share")).over(line)
    dealt = dealt.withColumn("upto", F.floor(upto + F.lit(0.5)))
    more = F.col("upto") - F.coalesce(F.lag("upto").over(line), F.lit(0))
    times = dealt.withColumn("more", more).select("doc_id", (F.floor("share") + F.col("more")).cast("int").alias("times")).where("times > 0")
    kept = docs.alias("d").join(times.withColumnRenamed("doc_id", "id").alias("t"), F.col("d.doc_id").eqNullSafe(F.col("t.id")))
    return kept.select("d.*", F.explode(F.sequence(F.lit(1), F.col("t.times"))).alias("_copy")).select(*[F.col(f"`{c}`") for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian 32-bit) per document row, checked by digests of
    the ids and of the decoded text."""
    out = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), vocabulary_path())
    return out.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "ids")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mixing", source_mixing),
    ("tokens", tokens),
]

#: Learned models and the tokenizer are beyond SQL; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
