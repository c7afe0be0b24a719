"""Quality gates: drop or count rows that break a rule, quarantine rows under the first rule they break."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from medallion.functions.cleaning import first_match

DROP = "drop"
WARN = "warn"
CLEAN = "clean"
QUARANTINE = "quarantine"


@dataclass(frozen=True)
class Expectation:
    """A SQL predicate every clean row should meet. Not TRUE (also NULL) counts as failed."""

    name: str
    predicate: str
    action: str = WARN


@dataclass(frozen=True)
class QuarantineRule:
    """A SQL predicate that marks a bad row, and the catalogue issue it belongs to."""

    label: str
    predicate: str
    issue_id: str


def expect_or_drop(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Keep rows for which every DROP rule is TRUE."""
    gates = [F.expr(r.predicate) for r in rules if r.action == DROP]
    return df.filter(reduce(Column.__and__, gates)) if gates else df


def _failures(rules: Sequence[Expectation]) -> list[Column]:
    return [F.count_if(~F.coalesce(F.expr(r.predicate), F.lit(False))).alias(r.name) for r in rules]


def expectation_metrics(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """One row per rule with passed and failed counts, from a single pass over the data."""
    totals = df.agg(F.count("*").alias("_rows"), *_failures(rules))
    lines = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.action).alias("action"),
            (F.col("_rows") - F.col(r.name)).alias("passed"),
            F.col(r.name).alias("failed"),
        )
        for r in rules
    ]
    return totals.select(F.inline(F.array(*lines)))


def observe_expectations(df: DataFrame, rules: Sequence[Expectation], into: Observation | str) -> DataFrame:
    """Count failures while the rows flow to another sink; batch (``Observation``) or stream (name)."""
    return df.observe(into, F.count(F.lit(1)).alias("rows"), *_failures(rules))


def _once_per(df: DataFrame, name: str, *labels: Column) -> DataFrame:
    """Every row once per label that is not NULL. A filter on the label would be moved below the cleaning
    expressions and evaluate all of them a second time; an exploded array is made where it stands."""
    return df.withColumn(name, F.explode(F.array_compact(F.array(*labels))))


def quarantine(df: DataFrame, entity: str, rules: Sequence[QuarantineRule]) -> DataFrame:
    """Rows that break a rule, stamped with the first such rule, the time and the entity."""
    return _once_per(df, "_dq_rule", first_match([(r.label, r.predicate) for r in rules])).withColumns(
        {"_dq_detected_at": F.current_timestamp(), "_entity": F.lit(entity)}
    )


def split_quality(
    df: DataFrame, entity: str, expectations: Sequence[Expectation], rules: Sequence[QuarantineRule]
) -> tuple[DataFrame, DataFrame]:
    """Clean rows and quarantined rows. They overlap: a row that only breaks a WARN rule is in both."""
    return expect_or_drop(df, expectations), quarantine(df, entity, rules)


def tag_quality(
    df: DataFrame, entity: str, expectations: Sequence[Expectation], rules: Sequence[QuarantineRule]
) -> DataFrame:
    """The same split in one pass: every row once per table it belongs to, named in ``_table``.

    Written partitioned by ``_table`` this feeds both tables from a single scan, with nothing cached.
    """
    gates = [F.expr(r.predicate) for r in expectations if r.action == DROP]
    labelled = df.withColumns(
        {
            "_dq_rule": first_match([(r.label, r.predicate) for r in rules]),
            "_dq_detected_at": F.current_timestamp(),
            "_entity": F.lit(entity),
        }
    )
    clean = F.when(reduce(Column.__and__, gates, F.lit(True)), F.lit(CLEAN))
    return _once_per(labelled, "_table", clean, F.when(F.col("_dq_rule").isNotNull(), F.lit(QUARANTINE)))
