"""The token vault: sequential, reversible tokens per column, in the order values are first seen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.saved import running

SCHEMA = "column string, value string, number long"


def token(number):
    return F.concat(F.lit("TK-"), F.format_string("%06d", number))


def first_seen(values: DataFrame, *order: str) -> DataFrame:
    """(column, value, place): distinct values with the least place they were seen at; a pre-aggregated group."""
    return values.groupBy("column", "value").agg(F.min(F.struct(*order)).alias("place"))


def extend(vault: DataFrame, values: DataFrame, *order: str) -> DataFrame:
    """New rows for a vault (column, value, number): values that it lacks, numbered after its last, in order of first sight.

    Numbers come from one saved range partitioning, not from a sorted window: they are the same however often they are read.
    """
    new = first_seen(values, *order).join(vault.select("column", "value"), ["column", "value"], "left_anti")
    last = vault.groupBy("column").agg(F.max("number").alias("last"))
    placed = running(new.withColumn("n", F.lit(1)), ["column", "place"], "n", "vault")
    base = placed.groupBy("column").agg(F.min("before").alias("base")).join(last, "column", "left")
    number = F.col("before") - F.col("base") + 1 + F.coalesce("last", F.lit(0))
    return placed.join(base, "column").select("column", "value", number.alias("number"))


def look_up(values: DataFrame, vault: DataFrame) -> DataFrame:
    return values.join(vault.withColumn("token", token(F.col("number"))).drop("number"), ["column", "value"], "left")
