"""The text decision: rules first, then models from cheap to dear, each on distinct texts that are still undecided.

Models are callables from a pandas Series of texts to a Series of booleans; one that is None gives no signal.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.binding import bind
from ..functions.masking import trimmed
from ..sources.saved import saved

Model = Callable[[pd.Series], pd.Series]


def _decision(redact: bool, reason: Column | str) -> Column:
    return F.struct(F.lit(redact).alias("redact"), (F.lit(reason) if isinstance(reason, str) else reason).alias("reason"))


def _phi(*names: Column) -> Column:
    return F.concat(F.lit("simultaneous_matrix:phi_detected("), F.array_join(F.concat(*names), ","), F.lit(")"))


def rule_decision(clean: Column, found: Column) -> Column:
    """struct(redact, reason) as far as rules go; null where only a model, or the end of the cascade, decides."""
    return (
        F.when(text.is_clinical(clean) | text.is_pure_clinical(clean), _decision(False, "clinical:allowlist"))
        .when(text.has_demographic_label(clean), _decision(True, _phi(F.array(F.lit("regex:demographic_label")), found)))
    )


def numeric_decision(clean: Column, found: Column) -> Column:
    """struct(redact, reason) of texts without a pattern that hold no word."""
    none = F.size(found) == 0
    return (
        F.when(none & clean.rlike("(?U)" + text.EXPOSURE), _decision(False, "clinical:exposure_number"))
        .when(none & ~clean.rlike("[A-Za-z]"), _decision(False, "fallback:numeric_non_phi"))
    )


def last_decision(found: Column) -> Column:
    """struct(redact, reason) where no model speaks up."""
    return _decision(True, F.when(F.size(found) > 0, _phi(found)).otherwise("fallback:unclassified_text"))


def _flag(model: Model):
    @F.pandas_udf("boolean")
    def run(values: pd.Series) -> pd.Series:
        return model(values).fillna(False).astype(bool)

    return run


def by_rules(value: Column) -> Column:
    """struct(redact, reason) of the cascade without models, one expression; null for empty texts."""
    every = lambda clean: bind(text.pattern_reasons(clean), lambda found: F.coalesce(rule_decision(clean, found), numeric_decision(clean, found), last_decision(found)))
    return bind(trimmed(value), lambda clean: F.when(clean != "", every(clean)))


def classify(rows: DataFrame, column: str = "text", person: Model | None = None, identity: Model | None = None, medical: Model | None = None, zero_shot: Model | None = None) -> DataFrame:
    """rows with redact and reason. Empty texts are not flagged (reason null).

    person, identity: models of personal data; the second is asked where the first is silent. medical, zero_shot:
    models of medical terms, asked where no other signal than a pattern is left. Without models the rules decide row by row,
    without a shuffle. With models each distinct text is decided once: what a stage leaves undecided is saved, so no model sees a text twice.
    """
    if not any((person, identity, medical, zero_shot)):
        out = rows.withColumn("_d", by_rules(F.col(column)))
        return out.withColumn("redact", F.coalesce("_d.redact", F.lit(False))).withColumn("reason", F.col("_d.reason")).drop("_d")
    value, found = F.col("_t"), F.col("_p")
    todo = rows.select(trimmed(F.col(column)).alias("_t")).filter(F.col("_t") != "").distinct().withColumn("_p", text.pattern_reasons(value))
    decided: list[DataFrame] = []

    def settle(decision: Column) -> None:
        """Save todo with a decision, and keep what it leaves open."""
        nonlocal todo
        stage = saved(todo.withColumn("_d", decision), "cascade")
        decided.append(stage.filter("_d is not null").select("_t", "_d"))
        todo = stage.filter("_d is null").drop("_d")

    def ask(model: Model | None, make: Column) -> None:
        nonlocal todo
        if model:
            todo = saved(todo.withColumn("_f", _flag(model)(value)), "cascade-model")
            decided.append(todo.filter("_f").select("_t", make.alias("_d")))
            todo = todo.filter("not _f").drop("_f")

    settle(rule_decision(value, found))
    ask(person, _decision(True, _phi(found, F.array(F.lit("presidio")))))
    ask(identity, _decision(True, _phi(F.array(F.lit("stanford_deid")), found)))
    settle(numeric_decision(value, found))
    kept = lambda source: _decision(False, F.concat(F.when(F.size(found) > 0, "simultaneous_matrix:medical_preserved").otherwise("simultaneous_matrix:medical_entity_preserved"), F.lit(f"({source})")))
    ask(medical, kept("biomedical_ner"))
    ask(zero_shot, kept("gliner"))
    every = todo.select("_t", last_decision(found).alias("_d"))
    for part in decided:
        every = every.unionByName(part)
    out = rows.withColumn("_k", trimmed(F.col(column))).join(every, F.col("_k") == F.col("_t"), "left")
    return out.withColumn("redact", F.coalesce("_d.redact", F.lit(False))).withColumn("reason", F.col("_d.reason")).drop("_k", "_t", "_d")
