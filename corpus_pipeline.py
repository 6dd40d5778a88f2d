"""A training corpus from ``documents``: five stages, each on all that the one before it kept.

1. toxicity: texts that score 0.7 or more go.
2. simhash: of each group of near-duplicates the smallest doc_id stays.
3. decontamination: documents that hold a passage of ``benchmark`` go.
4. secrets: found secrets are replaced by a mark; no document goes.
5. mixing: documents are repeated or left out so that the sources meet their target weights.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mostrador.llm.common import table
from mostrador.llm.decontaminate import remove_contaminated
from mostrador.llm.mixing import mix
from mostrador.llm.secrets import redact
from mostrador.llm.simhash import keep_one_per_group
from mostrador.llm.toxicity import remove_toxic
from mostrador.session import delete, intermediate, settle


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_toxic(docs, table(spark, sf_dir, "labels"))


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of ``docs`` and ``copy``, the number of the repetition."""
    return mix(docs)


STAGES = [
    ("toxicity", toxicity),
    ("simhash", simhash),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mixing", mixing),
]

#: The toxicity stage is a trained network, which SQL cannot express; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus: every stage is written as Parquet in the shared folder and read again by the next one.

    When a stage is written, the tables it made on its way and the stage before it are deleted.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with intermediate(spark) as paths:
            docs = settle(stage(spark, docs, sf_dir), f"corpus-{name}")
            written = paths.pop()  # the stage itself, which stays
        if before:
            delete(spark, before)
        before = written
    return docs
