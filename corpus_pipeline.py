"""From raw documents to packed training sequences, in four stages.

Each stage works on all that its predecessor kept, written as Parquet and read again.  All but the
last return the columns of documents.

Null and empty texts are empty documents: they are rated and scored like others, link with nothing,
and are packed as their end id alone.  Repeated rows are each rated and scored; the Jaccard stage keeps
one of rows that repeat id and text, and all rows without an id.  An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import jaccard, packing, quality_fm, toxicity
from lodestone.llm.common import new_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model rejects go."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.rate(docs, model).where(~F.col("toxic")).select(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores below its threshold go."""
    machine = quality_fm.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_fm.score(docs, machine).where(F.col("score") >= quality_fm.THRESHOLD).select(*docs.columns)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at a similarity of 0.8 over five-word shingles, the one of the smallest id stays.

    Rows that repeat an id and its text are one document; rows without an id stay.
    """
    found = jaccard.join(docs, percent=80, words=5)
    kept = found.where("doc_id = component_id").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return named.unionByName(docs.where("doc_id is null")).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of sequences of 2048 tokens."""
    return packing.packed_documents(docs)


STAGES = [("toxicity", toxicity_stage), ("quality", quality_stage), ("jaccard", jaccard_stage), ("packing", packing_stage)]

#: Trained models, components and packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
