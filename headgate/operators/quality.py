"""Data-quality findings and run thresholds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headgate.functions.values import ntz_literal, ntz_micros
from headgate.operators.scan import union_all


@dataclass(frozen=True)
class Rule:
    """A finding for every row for which `broken` is true."""

    issue: str
    severity: str
    broken: Column


def quality_events(df: DataFrame, entity: str, key: str, rules: list[Rule]) -> DataFrame:
    """One row per finding; all rules are tested in one pass."""
    findings = F.array(
        *[
            F.when(r.broken, F.struct(F.lit(r.issue).alias("issue"), F.lit(r.severity).alias("severity")))
            for r in rules
        ]
    )
    return (
        df.select(F.col(key).cast("string").alias("key"), F.explode(F.array_compact(findings)).alias("f"))
        .select(F.lit(entity).alias("entity"), "key", "f.issue", "f.severity")
    )


def quality_summary(events: list[DataFrame]) -> DataFrame:
    """Findings per entity, issue and severity."""
    return union_all(events).groupBy("entity", "issue", "severity").agg(F.count(F.lit(1)).alias("findings"))


def threshold_check(
    df: DataFrame, labels: list[str], ts: str, started: str, min_rate: float, max_first_seconds: float, max_records: int
) -> DataFrame:
    """Rate, time to first record and row count of a run against its limits."""
    start = ntz_micros(ntz_literal(started))
    per_run = df.groupBy(*labels).agg(
        F.count(F.lit(1)).alias("records"),
        ((ntz_micros(F.min(ts)) - start) / 1e6).alias("first_record_seconds"),
        ((ntz_micros(F.max(ts)) - ntz_micros(F.min(ts))) / 1e6).alias("seconds"),
    )
    rate = F.round(F.col("records") / F.nullif(F.col("seconds"), F.lit(0.0)), 6)
    return per_run.select(
        *labels,
        "records",
        "first_record_seconds",
        rate.alias("records_per_second"),
        F.coalesce(rate >= min_rate, F.lit(True)).alias("rate_ok"),
        (F.col("first_record_seconds") <= max_first_seconds).alias("first_record_ok"),
        (F.col("records") <= max_records).alias("records_ok"),
    )
