"""A run's settings before any Spark job: the job document and its checks, policy selection, key stores, kept tags, environment."""

from __future__ import annotations

import json
import os
import secrets
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import policy

#: What a document may name as operations: the block itself and the actions it uses.
OPERATIONS = ("dicom_deidentify", *policy.ACTIONS, "keep")


@dataclass
class Job:
    """A checked document: its actions, and what was noted but is no error."""

    config: policy.JobConfig
    undeclared: list[str] = field(default_factory=list)
    overruled: list[str] = field(default_factory=list)


def check(document: Any, fixed: Mapping[str, Any] | None = None, temp_dir: str = "/tmp/run", dictionary: dict[str, str] | None = None) -> Job | None:
    """The job of a document; None without a policy block. ValueError for what cannot be run.

    fixed: the server's values, which stand whatever the document says; fields that disagree (pixel.* among them) are noted.
    Operations must be known ones; actions used but not declared are noted.
    """
    if not isinstance(document, dict):
        raise ValueError("a job must be an object")
    block = document.get("dicom_deidentify")
    if block is None:
        return None
    if not os.path.abspath(temp_dir).startswith("/tmp/"):
        raise ValueError("the folder of files not yet treated must lie under /tmp")
    operations = document.get("operations")
    if operations is not None and (not isinstance(operations, list) or any(not isinstance(o, str) or o not in OPERATIONS for o in operations)):
        raise ValueError("operations must be a list of known ones")
    config = policy.parse_job(document, dictionary)
    flat = {**block, **{f"pixel.{k}": v for k, v in (block.get("pixel") or {}).items()}} if isinstance(block.get("pixel"), dict) else block
    overruled = sorted(k for k, v in (fixed or {}).items() if k in flat and flat[k] != v)
    return Job(config, sorted({a.action for a in config.actions} - set(operations or [])), overruled)


def load(path: str, **checks: Any) -> Job | None:
    """The job in a file: None where there is none, ValueError where it cannot be read."""
    if not Path(path).exists():
        return None
    try:
        document = json.loads(Path(path).read_text("utf-8"))
    except (OSError, ValueError) as wrong:
        raise ValueError(f"unreadable job: {wrong}") from wrong
    return check(document, **checks)


def selected_policy(job: Job | None, enabled: bool = True) -> str:
    """Which policy runs: the job's, else none where switched off, else the fixed one."""
    return "config" if job is not None else "fixed" if enabled else "none"


def unknown_kept(keywords: list[str], dictionary: Mapping[str, str] = policy.KEYWORDS) -> list[str]:
    """Keywords to be kept that no tag has: a run with any ends with exit code 1."""
    return [k for k in keywords if k not in dictionary]


def environment_int(name: str, values: Mapping[str, str] | None = None) -> int | None:
    """A whole number from 1 in the environment; None where unset, SystemExit where it is anything else."""
    raw = (os.environ if values is None else values).get(name, "").strip()
    if not raw:
        return None
    if not raw.lstrip("+-").isdigit() or int(raw) < 1:
        raise SystemExit(f"{name} must be a whole number from 1")
    return int(raw)


def new_key(n_bytes: int = 16) -> str:
    """A random key in hex; 32 bytes make a salt."""
    return secrets.token_hex(n_bytes)


class KeyStore:
    """Keys per store (hash, symmetric, format-preserving) and column, made on first use; columns are bounded by the tag dictionary."""

    SCHEMA = "store string, column string, key string"

    def __init__(self, spark: SparkSession, held: DataFrame | None = None):
        self.spark = spark
        self.keys = {(r["store"], r["column"]): r["key"] for r in held.collect()} if held is not None else {}

    def get(self, store: str, column: str) -> str:
        return self.keys.setdefault((store, column), new_key())

    def key(self, store: str, columns: list[str]):
        """A function from a column's name to its key, for fixed_rewrite."""
        pairs = [F.lit(x) for c in columns for x in (c, self.get(store, c))]
        return lambda column: F.element_at(F.create_map(*pairs), column)

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame([(s, c, k) for (s, c), k in sorted(self.keys.items())], self.SCHEMA)


def sheet_titles(names: list[str]) -> list[str]:
    """Titles of at most 31 characters without those that a sheet may not have; repeats are numbered from 2."""
    out: list[str] = []
    for name in names:
        base = "".join("_" if c in "[]:*?/\\" else c for c in os.path.basename(os.path.normpath(name)))[:31]
        title, k = base, 2
        while title in out:
            title, k = f"{base[:28]}_{k}", k + 1
        out.append(title)
    return out


def recognised(result: Any, default: float = 0.9) -> list[tuple[Any, str, float]]:
    """(points, text, confidence) of a recogniser's output: lines of points and (text, confidence), or of points, text and confidence; one more list around them or not."""
    if not isinstance(result, list) or not result:
        return []
    nested = isinstance(result[0], list) and len(result) == 1 and result[0] and isinstance(result[0][0], list)
    plain, out = not isinstance(result[0], list), []

    def number(value: Any) -> float:
        try:
            return float(value)
        except (TypeError, ValueError):
            return default

    for line in result[0] if nested else result:
        if not isinstance(line, (list, tuple)) or len(line) < (3 if plain else 2):
            continue
        points, words = line[0], line[1]
        if plain:
            out.append((points, str(words), number(line[2])))
        elif isinstance(words, (list, tuple)) and len(words) >= 2:
            out.append((points, str(words[0]), float(words[1])))
        elif isinstance(words, str):
            out.append((points, words, float(line[2]) if len(line) > 2 else default))
    return out


def run_totals(audits: DataFrame) -> DataFrame:
    """One row: files, failed ones, regions redacted and matched to tags, bytes, tags changed and peak memory of audits.

    audits: path, error, n_redacted, n_matched, bytes, changed array<boolean>, peak_mb.
    """
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    changed = F.size(F.filter("changed", lambda x: F.coalesce(x, F.lit(True))))
    return audits.agg(F.count("*").alias("files"), F.count_if(F.col("error").isNotNull()).alias("failed"), total("n_redacted"), total("n_matched"), total("bytes"),
                      F.sum(F.greatest(changed, F.lit(0))).alias("tags_changed"), F.max("peak_mb").alias("peak_mb"))


def append_record(record: DataFrame, path: str) -> None:
    """Append benchmark records to a folder of JSON lines."""
    record.write.mode("append").json(path)


def blob_lines(boxes: DataFrame, gap: float = 8.0) -> DataFrame:
    """boxes with line, numbered from 0 per file: in order of (centre, x1), a new line where the centre is over gap lower than the last."""
    from pyspark.sql import Window as W

    order = W.partitionBy("file_id").orderBy("_centre", "x1", "idx")
    marked = boxes.withColumn("_centre", (F.col("y1") + F.col("y2")) / 2)
    marked = marked.withColumn("_new", (F.coalesce(F.col("_centre") - F.lag("_centre").over(order), F.lit(0.0)) > gap).cast("int"))
    return marked.withColumn("line", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, 0))).drop("_centre", "_new")


def distinct_boxes(boxes: DataFrame) -> DataFrame:
    return boxes.select("file_id", "x1", "y1", "x2", "y2").distinct()
