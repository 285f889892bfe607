"""A training corpus from raw documents: five stages, each a written table that the next one reads.

Language identification rejects documents it can name no language for, SimHash leaves one document of
each group of near-duplicates, contaminated documents go, personal data is masked, and every
document that is left gets the rate at which it is drawn so that the domains meet their targets.

All stages but the last return the columns they were given, whatever these are called; the last adds
its own, with `mixed_` before a name that is taken. Null, empty and letterless texts go in the first
stage, as no language can be named for them. Rows without an id, and rows that share one, are rows of
their own: of copies one stays, with the smallest id, if any has one. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from headgate.llm.decontaminate import decontaminate
from headgate.llm.language import keep_identified
from headgate.llm.mixing import domain_labels, with_rates
from headgate.llm.personal import mask_personal
from headgate.llm.simhash import deduplicate
from headgate.llm.tables import kept, read

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicate(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, read(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mask_personal(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_rates(docs, domain_labels(read(spark, sf_dir, "labels")))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("mixing", mixing_stage),
]

#: Learned models and fingerprints are beyond SQL; tests hold the stages against plain code.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
