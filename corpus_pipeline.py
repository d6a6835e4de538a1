"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before has kept, and
returns a DataFrame; all but the last return the columns of `documents`. Stages are
written as Parquet and read again in between.

Defined cases are those of the operators: null texts are no reason to drop a document,
repeated rows are copies, and empty tables pass through as such.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfdiff.llm import decontaminate, forest, line_spread, packing, toxicity
from shelfdiff.session import settle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5, as learnt from four fifths of the labelled rows."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learn = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    return toxicity.remove_toxic(docs, toxicity.fit(docs, labels, learn))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that are spread over many sources; n_chars follows."""
    out = line_spread.dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id, of each group of near copies."""
    return forest.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and places there."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over the table `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


# A trained model, tokenizer ids and packing are beyond SQL.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
