"""Audit and benchmark reports: technique counts, statuses, stage statistics, throughput, inventories, resume, names, plans."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..functions import masking, text
from ..sources.saved import running


def by_technique(audit: DataFrame) -> DataFrame:
    """Per file, (technique, count) of what changed, and the number of tags touched; emptied and retained ones do not count."""
    real = audit.filter(F.coalesce(F.col("changed"), F.lit(True)) & ~F.col("action").isin("skipped-empty", "retained"))
    counts = real.groupBy("file_id", "technique").agg(F.count("*").alias("n"))
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("technique", "n"))))
    return counts.groupBy("file_id").agg(entries.alias("tags_by_technique"), F.sum("n").alias("tags_touched"))


def statistics(rows: DataFrame, value: str, *keys: str) -> DataFrame:
    """n, mean, p50, p90, p99, max, sum per key; percentiles are the values at the half-even rounded index q(n-1).

    Equal values are counted first, then ranges of (key, value) are numbered side by side: no task sorts a whole key.
    """
    counts = rows.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    placed = running(counts, [*keys, value], "_n", "statistics")
    total = F.sum(F.col(value) * F.col("_n"))
    of = placed.groupBy(*keys).agg(F.sum("_n").alias("n"), F.min("before").alias("_base"), (total / F.sum("_n")).alias("mean"), F.max(value).alias("max"), total.alias("sum"))
    at = F.col("before") - F.col("_base")

    def spot(q: float) -> Column:
        index = masking.python_round_index(F.col("n"), q)
        return F.max(F.when((at <= index) & (index < at + F.col("_n")), F.col(value)))

    picked = placed.join(of.select(*keys, "n", "_base"), list(keys)).groupBy(*keys).agg(spot(0.5).alias("p50"), spot(0.9).alias("p90"), spot(0.99).alias("p99"))
    return of.join(picked, list(keys)).select(*keys, "n", "mean", "p50", "p90", "p99", "max", "sum")


def throughput(files: Column, seconds: Column) -> list[Column]:
    return [F.try_divide(files * 60, seconds).alias("files_per_minute"), F.try_divide(seconds, files).alias("seconds_per_file")]


def resume(inputs: DataFrame, finished: DataFrame) -> DataFrame:
    """Inputs without an error-free audit of the same path."""
    return inputs.join(finished.filter("error is null").select("path"), "path", "left_anti")


def unique_names(files: DataFrame) -> DataFrame:
    """files (path, stem) with name: in path order the stem, or the first of stem_2, stem_3 and so on that no earlier file took.

    Stems depend on each other only where one is another, repeated one and a number (a_2 beside several a): those meet by their root,
    the stem without its trailing numbers, and are named in path order. All others are numbered by a window.
    """
    stems = files.groupBy("stem").agg(F.count("*").alias("_n"))
    longer = stems.filter(F.col("stem").rlike("_[1-9][0-9]*$")).select(F.col("stem").alias("_longer"), F.regexp_replace("stem", "_[1-9][0-9]*$", "").alias("stem"))
    pairs = longer.join(stems.filter("_n > 1"), "stem")
    tangled = pairs.select("stem").union(pairs.select("_longer")).distinct()
    k = F.row_number().over(W.partitionBy("stem").orderBy("path"))
    plain = files.join(tangled, "stem", "left_anti").withColumn("name", F.when(k == 1, F.col("stem")).otherwise(F.concat_ws("_", "stem", k.cast("string"))))

    def settle(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("path", kind="stable").drop(columns="_root")
        return group.assign(name=unique_names_of(group["stem"].tolist()))

    some = files.join(tangled, "stem", "left_semi").select(*files.columns).withColumn("_root", F.regexp_replace("stem", "(_[1-9][0-9]*)+$", ""))
    schema = T.StructType([*files.schema.fields, T.StructField("name", T.StringType())])
    return plain.select(*files.columns, "name").unionByName(some.groupBy("_root").applyInPandas(settle, schema))


def unique_names_of(stems: list[str]) -> list[str]:
    """Names of stems in order; a numbered name that is taken already is passed over."""
    taken: set[str] = set()
    used: dict[str, int] = {}
    out = []
    for stem in stems:
        name, k = stem, used.get(stem, 1)
        while name in taken:
            k += 1
            name = f"{stem}_{k}"
        used[stem] = k
        taken.add(name)
        out.append(name)
    return out


def cell(elements: DataFrame, most: int = 32000) -> Column:
    """A tag's text in the inventory: several values with a backslash between, binary as its size, without control characters."""
    joined = F.array_join("vals", "\\")
    shown = F.when(F.col("vr").isin("OB", "OW", "OF", "UN"), F.concat(F.lit("<"), F.octet_length(joined).cast("string"), F.lit(" bytes>"))).otherwise(joined)
    return F.substring(F.regexp_replace(shown, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", ""), 1, most)


def column_name() -> Column:
    return F.coalesce(F.nullif(F.col("keyword"), F.lit("")), F.format_string("(%04X,%04X)", "grp", "elem"))


def inventory(elements: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per file, one column per top-level tag, columns in order of first sight (a list that is bounded by the dictionary)."""
    cells = elements.filter("path = ''").withColumn("name", column_name()).withColumn("cell", cell(elements))
    if columns is None:
        columns = [r["name"] for r in cells.groupBy("name").agg(F.min(F.struct("file_id", "seq")).alias("p")).orderBy("p").collect()]
    return cells.groupBy("file_id").pivot("name", columns).agg(F.first("cell"))


def chest(rows: DataFrame) -> DataFrame:
    reason = text.chest_reason(F.col("has_rows"), F.col("modality"), F.col("body"), F.col("study"), F.col("series"))
    return rows.withColumn("reason", F.coalesce(reason, F.lit("image; BodyPartExamined=CHEST; descriptions consistent"))).withColumn("is_chest", reason.isNull())


def worker_plan(cpus: Column, mb: Column, files: Column, model_mb: int = 4500, each_mb: int = 1500, spare_mb: int = 512, threads: int = 8) -> list[Column]:
    """Workers and threads of a machine: bounded by processors, memory (if known) and files; at least one of each."""
    by_cpu = F.floor(cpus / threads)
    by_mb = F.when(mb.isNull(), by_cpu).otherwise(F.floor((mb - model_mb - spare_mb) / each_mb))
    workers = F.greatest(F.lit(1), F.least(by_cpu, by_mb, files))
    return [workers.cast("int").alias("workers"), F.greatest(F.lit(1), F.floor(cpus / workers)).cast("int").alias("threads")]


def publishable(audit: DataFrame) -> DataFrame:
    """An audit whose regions carry boxes only, never text."""
    return audit.withColumn("regions", F.transform("regions", lambda r: F.struct(r["x1"].alias("x1"), r["y1"].alias("y1"), r["x2"].alias("x2"), r["y2"].alias("y2"))))


def manifest(summary: DataFrame, path: str) -> None:
    """The run's manifest as JSON lines in a folder; written to the end or not at all by the sink's commit."""
    summary.write.mode("overwrite").json(path)


def output_path(path: Column, root: str, layout: str = "mirror", name: Column | None = None) -> Column:
    """Where a file's output goes: the same relative path (mirror), or a folder of its own under its name (per-file)."""
    relative = F.regexp_replace(path, "^/+", "")
    return F.concat_ws("/", F.lit(root.rstrip("/")), relative) if layout == "mirror" else F.concat_ws("/", F.lit(root.rstrip("/")), name, F.regexp_extract(relative, "[^/]+$", 0))


def with_sibling(files: DataFrame, others: DataFrame, suffix: str = ".jpg") -> DataFrame:
    """Files (path) that have a file of the same name but suffix among others (path)."""
    derived = F.regexp_replace(files["path"], r"\.[^./]+$", suffix)
    return files.join(others.select(F.col("path").alias("_p")), derived == F.col("_p"), "left_semi")


def string_map(document: Column) -> Column:
    """The entries of a JSON object that are strings; null for anything else."""
    entries = F.from_json(document, "map<string,variant>")
    strings = F.map_filter(entries, lambda k, v: F.schema_of_variant(v) == "STRING")
    return F.transform_values(strings, lambda k, v: F.variant_get(v, "$", "string"))


def folder_summary(reports: DataFrame, runs: DataFrame) -> DataFrame:
    return reports.join(runs, "folder", "left")
