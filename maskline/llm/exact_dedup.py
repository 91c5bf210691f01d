"""Exact dedup by distributed most-significant-digit radix partitioning.

Texts are equal when identical after deleting the characters in BLANKS. A document's digit at level L is the next run of
its bytes (64, then to sixteen times as far per level), with a mark that the text ends there. Each level splits every group
by the digit; groups of one leave, groups whose text has ended are final, the rest go on. Equality is decided by the
bytes alone. Everything runs in the JVM; groups are only ever counted with map-side combine, never gathered.

Defined results: null text counts as empty; all empty texts are one group; rows with equal (even null) ids stay apart,
each with its own row number; a null id sorts after any other; an empty table gives an empty result; other columns of
the input, whatever their names, are carried by the caller and never read here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import Workspace, free_name, numbered, sized

#: Deleted before comparing: space, and U+0009 to U+000D.
BLANKS = " \t\n\x0b\f\r"
#: Bytes of the first digit, and how much wider each next one is.
FIRST, WIDEN = 64, 16


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def keyed(docs: DataFrame, work: Workspace, text: str = "text", doc_id: str = "doc_id", rid: str | None = None) -> DataFrame:
    """One saved row per document: a row number (rid names one that docs has), the id, length, digest, first digit, and the rest."""
    norm = normalised(F.col(text))
    raw = norm.cast("binary")
    return work.save(
        docs.select(
            (F.col(rid) if rid else F.monotonically_increasing_id()).alias("rid"),
            F.col(doc_id).cast("long").alias("doc_id"),
            F.length(F.coalesce(F.col(text), F.lit(""))).alias("n_chars"),
            F.sha2(raw, 256).alias("text_sha256"),
            F.octet_length(norm).cast("long").alias("n_bytes"),
            F.substring(raw, 1, FIRST).alias("head"),
            F.substring(raw, FIRST + 1, 2**31 - 1).alias("rest"),
        ),
        "keyed",
    )


def _split(active: DataFrame, work: Workspace, until: int) -> tuple[DataFrame, int]:
    """active (rid, gid, digit, n_bytes, ...) with each row's group split by its digit; groups of one are gone."""
    ended = F.col("n_bytes") <= until
    groups = work.save(
        active.groupBy("gid", "digit", ended.alias("ended")).agg(F.min("rid").alias("next"), F.count("*").alias("size"))
        .filter("size > 1").drop("size"),
        "groups",
    )
    n = groups.count()
    # later digits are as wide as the texts: there, a join that shuffles at every size
    side = sized(groups, n, FIRST + 64) if until == FIRST else groups
    hit = active.withColumn("ended", ended).join(side, ["gid", "digit", "ended"])
    return hit.drop("gid", "digit").withColumnRenamed("next", "gid"), n


def exact_groups(rows: DataFrame, work: Workspace) -> DataFrame:
    """(rid, gid) of every row of keyed() whose text another row shares; gid is one number per distinct text."""
    first, n = _split(rows.select("rid", F.lit(0).cast("long").alias("gid"), F.col("head").alias("digit"), "n_bytes"), work, FIRST)
    first = work.save(first, "level0")
    done = [first.filter("ended").select("rid", "gid")]
    going = first.filter("not ended").select("rid", "gid")
    left = going.count() if n else 0
    if left:
        active = work.save(rows.select("rid", "n_bytes", "rest").join(sized(going, left, 32), "rid"), "active")
        start, width = FIRST, FIRST * (WIDEN - 1)
        while left:
            digit = F.substring("rest", start - FIRST + 1, width)
            level, n = _split(active.select("rid", "gid", "n_bytes", digit.alias("digit"), "rest"), work, start + width)
            level = work.save(level, "level")
            done.append(level.filter("ended").select("rid", "gid"))
            active = level.filter("not ended").drop("ended")
            left = active.count() if n else 0
            start, width = start + width, (start + width) * (WIDEN - 1)
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return out


def verdicts(rows: DataFrame, work: Workspace) -> DataFrame:
    """(rid, keep_id, keep_rid, group_size) of every row of keyed() that is in a group of two or more; saved.

    Of equal texts the row with the most code points in its original text stays, then the smallest id, then the first row.
    """
    order = F.struct((-F.col("n_chars")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("c"), F.col("rid").alias("d"))
    members = work.save(exact_groups(rows, work).join(rows.select("rid", "doc_id", "n_chars"), "rid"), "members")
    best = work.save(
        members.groupBy("gid").agg(F.count("*").alias("group_size"), F.min(order).alias("k"))
        .select("gid", "group_size", F.col("k.c").alias("keep_id"), F.col("k.d").alias("keep_rid")),
        "best",
    )
    return work.save(members.select("rid", "gid").join(sized(best, best.count(), 64), "gid").drop("gid"), "verdicts")


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: rid, doc_id, keep_id, keep_rid, group_size, kept, text_sha256."""
    work = Workspace(docs.sparkSession, "exact")
    rows = keyed(docs, work, text, doc_id)
    found = verdicts(rows, work)
    grouped = F.col("group_size").isNotNull()
    return (
        rows.select("rid", "doc_id", "text_sha256")
        .join(sized(found, found.count(), 64), "rid", "left")
        .select(
            "rid", "doc_id",
            F.when(grouped, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
            F.coalesce("keep_rid", "rid").alias("keep_rid"),
            F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
            F.coalesce(F.col("keep_rid") == F.col("rid"), F.lit(True)).alias("kept"),
            "text_sha256",
        )
    )


def drop_exact_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", work: Workspace | None = None) -> DataFrame:
    """docs without the rows that exact_dedup drops; columns as they were."""
    work = work or Workspace(docs.sparkSession, "exact-rows")
    (rid,) = free_name(docs, "row_number")
    held = numbered(docs, rid, work)
    found = verdicts(keyed(held, work, text, doc_id, rid), work)
    gone = work.save(found.filter("rid <> keep_rid").select(F.col("rid").alias(rid)), "gone")
    work.only(held, gone)
    return held.join(sized(gone, gone.count(), 16), rid, "left_anti").drop(rid)
