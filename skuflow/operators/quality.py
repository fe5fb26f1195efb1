"""Quality operators (Q1–Q7): required columns, missing SKUs, row contracts, the
publication gate, per-source metrics, channel status, coercion counts."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ContractViolation(Exception):
    """Raised by :func:`gate` — nothing may be published."""


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Q1: schema-only check (no job runs)."""
    present = set(df.columns)
    return [c for c in required if c not in present]


def missing_skus(present: DataFrame, sku_dim: DataFrame, by: str | None = None,
                 groups: Sequence[str] = ()) -> DataFrame:
    """Q2: master SKUs absent from a source — per configured group (channel or
    source name in column ``by``) when given.

    The (group, SKU) expectation is generated by exploding the configured group
    list over the SKU dimension, then anti-joined with what is present.
    """
    skus = sku_dim.select(F.col("SKU").cast("string").alias("SKU"))
    if by is None:
        return skus.join(present.select("SKU"), "SKU", "left_anti")
    expected = skus.select(F.explode(F.array(*[F.lit(g) for g in groups])).alias(by), "SKU")
    return expected.join(present.select(by, "SKU"), [by, "SKU"], "left_anti")


@dataclass
class Rule:
    """One row-contract rule: a name, the column it guards and a predicate that is
    TRUE for a *valid* value (NULL counts as a violation)."""

    column: str
    name: str
    valid: Column


@dataclass
class Contract:
    rules: list[Rule] = field(default_factory=list)

    @staticmethod
    def of(required: Sequence[str] = (), non_negative: Sequence[str] = (), integral: Sequence[str] = ()) -> "Contract":
        rules = [Rule(c, "required", F.col(c).isNotNull()) for c in required]
        rules += [Rule(c, "non_negative", F.col(c) >= 0) for c in non_negative]
        rules += [Rule(c, "integral", F.col(c).cast("double") == F.floor(F.col(c).cast("double")))
                  for c in integral]
        return Contract(rules)


def violations(contract: Contract) -> list[Column]:
    """Q3: per rule, the aggregate that counts its violating rows."""
    return [F.coalesce(F.sum(F.when(F.coalesce(r.valid, F.lit(False)), 0).otherwise(1)), F.lit(0)).cast("long")
            for r in contract.rules]


def violation_counts(df: DataFrame, contract: Contract) -> DataFrame:
    """Q3: one row per rule with the number of violating rows (one aggregate pass)."""
    wide = df.agg(*[n.alias(f"_{i}") for i, n in enumerate(violations(contract))])
    rows = F.array(*[F.struct(F.lit(r.column).alias("column"), F.lit(r.name).alias("rule"),
                              F.col(f"_{i}").alias("violations"))
                     for i, r in enumerate(contract.rules)])
    return wide.select(F.explode(rows).alias("_v")).select("_v.*")


def violating_rows(df: DataFrame, contract: Contract) -> DataFrame:
    """Q3: the offending rows themselves, with the names of the broken rules."""
    broken = F.array_compact(F.array(*[
        F.when(~F.coalesce(r.valid, F.lit(False)), F.lit(f"{r.column}:{r.name}")) for r in contract.rules]))
    return df.withColumn("broken_rules", broken).where(F.size("broken_rules") > 0)


def gate(df: DataFrame, contract: Contract) -> None:
    """Q4: all-or-nothing — one aggregate action; raise before anything is written."""
    total = df.agg(F.sum(F.when(
        F.array_contains(F.array(*[F.coalesce(r.valid, F.lit(False)) for r in contract.rules]), False), 1)
        .otherwise(0)).alias("n")).first()["n"] or 0
    if total:
        raise ContractViolation(f"{total} row(s) violate the report contract")


def source_metrics(raw: DataFrame, found: DataFrame, source: str) -> DataFrame:
    """Q5: rows analyzed (raw rows) and SKU rows found for one source, as one row."""
    both = (raw.select(F.lit(1).alias("a"), F.lit(0).alias("f"))
            .unionByName(found.select(F.lit(0).alias("a"), F.lit(1).alias("f"))))
    return both.agg(F.lit(source).alias("source"), F.sum("a").cast("long").alias("rows_analyzed"),
                    F.sum("f").cast("long").alias("rows_found"))


def channel_status(channels: Sequence[str], dates: DataFrame) -> DataFrame:
    """Q6: configured channel -> data date, or 'No data'. ``dates``: Channel, Date.
    The dates are reduced to one row per configured channel before the
    broadcast, so its size is bounded by the configuration."""
    spark = dates.sparkSession
    dim = spark.createDataFrame([(i, c) for i, c in enumerate(channels)], "channel_rank int, Channel string")
    per_channel = (dates.where(F.col("Channel").isin(list(channels)))
                   .groupBy("Channel").agg(F.max("Date").alias("Date")))
    return (dim.join(F.broadcast(per_channel), "Channel", "left")
            .select("Channel", "channel_rank", F.col("Date").alias("data_date"),
                    F.coalesce(F.date_format("Date", "yyyy-MM-dd"), F.lit("No data")).alias("status")))


def coercion_counts(df: DataFrame, pairs: dict[str, tuple[str, Column]], by: Sequence[str] = ()) -> DataFrame:
    """Q7: per group, how many present raw values failed to parse (and were forced
    to 0 by F1/F2). ``pairs``: output name -> (raw column, parsed-or-NULL column)."""
    from skuflow.functions.numeric import coerced

    return df.groupBy(*by).agg(*[F.sum(coerced(raw, parsed)).cast("long").alias(name)
                                 for name, (raw, parsed) in pairs.items()])
