"""A training corpus from raw documents: five stages, each on all that its predecessor kept.

1. toxicity: documents that the conditional random field rejects go;
2. near-duplicates: one document of each group stays;
3. decontamination: documents that leak a benchmark item go;
4. mixing: documents repeat or drop out so that sources meet their target weights;
5. sharding: every row gets a shard and a slot.

The first four return the columns of ``documents``, the last one adds ``size``,
``text_crc32``, ``shard`` and ``slot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, mixing, neardup, sharding, toxicity
from tidemark.llm.common import staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def _packed(docs: DataFrame) -> DataFrame:
    """All columns in one, beside those that the operator reads: no name can clash."""
    return docs.select(F.struct(*docs.columns).alias("_doc"), "doc_id", "text", "source")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(_packed(docs), mixing.quality_weights(table(spark, sf_dir, "labels")), carry=["_doc"])
    return mixed.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_doc.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    made = ("size", "text_crc32", "shard", "slot")
    out = sharding.shard_documents(_packed(docs), carry=["_doc"])
    return out.select(*[F.col("_doc")[c].alias(c) for c in docs.columns if c not in made], *made)


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"corpus-{k}")
    return docs
