"""Corpus pipeline: quality, toxicity, near-duplicates, packing. Each stage reads what the one before wrote.

Part of the folder ``maillage/llm`` and removed with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maillage.llm import curve_packing, near_duplicates, quality, toxicity
from maillage.llm.columns import bound_batches, stored, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones among them, does not reject."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.quality_score(model, F.col("text")) >= 0.5)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity machine, fitted on the labelled ones among them, does not reject."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.toxicity_score(model, F.col("text")) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates: that with the smallest doc_id. Repeated rows leave one.

    Texts that share a doc_id are judged each for itself.
    """
    del sf_dir
    bound_batches(spark)
    found = near_duplicates.find_near_duplicates(docs)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("text_md5").alias("_md5")).distinct()
    rest = docs.join(gone, (F.col("doc_id") == F.col("_id")) & (near_duplicates.text_md5(F.col("text")) == F.col("_md5")), "left_anti")
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where((F.col("n") > 1) & F.col("doc_id").isNotNull()).select("doc_id")
    if repeated.isEmpty():
        return rest
    again = rest.join(repeated, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"])
    return rest.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(again)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences along the curve, with a checksum of their ids."""
    del sf_dir
    bound_batches(spark)
    return curve_packing.pack(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [("quality", keep_quality), ("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("packing", pack)]

# Trained models, minima and tokenizer ids: no stage can be said in SQL. Tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
