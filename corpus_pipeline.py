"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. ``docs`` has the columns of
``documents``, and so has what all stages but the last return. Between stages rows are written as Parquet in the shared
folder and read again, so a lost executor never sends a run back to its beginning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolode.llm import decontaminate, lines, packing, simhash, toxicity
from chronolode.llm.common import kept, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity tagger rejects go. Labels of held-out rows are not read."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines within one edit of an earlier one leave their texts; documents of which no line is left go."""
    return lines.drop_repeated_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, its smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark text go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents left, with their places in sequences of 1024 tokens."""
    pieces = packing.token_pieces(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: The tagger and the latent space are trained, which SQL cannot say.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
