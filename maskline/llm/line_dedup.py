"""Line dedup by a suffix array over line ids, built by distributed prefix doubling. DataFrame functions only.

A document is the sequence of its lines (split at U+000A, empty lines among them). A line's id is 128 bits of hash; lines that occur
once start nothing that repeats and take no part. The rank of a place at depth h is where the places with its next h lines begin
among all places, in order of their lines. Doubling refines each group of equal rank by the ranks h lines on: distinct pairs of ranks
are counted, range-partitioned and summed up in order, so no task sorts a group. A place that is alone, or whose window
runs on to the end of its document or to a line that occurs once, keeps its rank; the others go on until none is left. The ranks at each depth are saved.

The places in order of their last rank are the suffix array. The common prefix of two neighbours is found from the saved ranks, from the
greatest depth down: where both have one rank at a depth, they share that many lines more. Stretches of the array whose neighbours
share `least_lines` lines or more are intervals: the copies of one run. In an interval every place but the first, by
(doc_id, row, place), is a later copy, and its lines are deleted; a longer run is deleted by the intervals of the places in it.

Defined results: null text stays null and has no lines, empty text is one empty line; rows with equal ids are ordered by row number,
null ids come last; lines are compared as they are; a run may overlap its first copy, within one document too; places are rows, so
no text is too long until its kept lines are joined again; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.saved import running
from .storage import Workspace, sized

#: Lines in the shortest run that is deleted.
LEAST_LINES = 2
LAST = 2**63 - 1


def suffix_ranks(lines: DataFrame, work: Workspace) -> tuple[DataFrame, list[DataFrame]]:
    """The repeated lines (doc, id, at, high, low) as a suffix array (doc, id, at, rank), and the ranks (doc, at, rank) of equal windows at depths 1, 2, 4, ...

    Places of equal rank that are not in the last depth's table agree up to the end of what they share with any place.
    """
    counts = lines.groupBy("high", "low").agg(F.count("*").alias("n")).filter("n > 1")
    first = running(counts, ["high", "low"], "n", "ids", work.save)
    open_ = work.save(lines.join(first.select("high", "low", F.col("before").alias("rank")), ["high", "low"]).select("doc", "id", "at", "rank"), "depth")
    depths, closed, h = [], [], 1
    while not open_.isEmpty():
        depths.append(open_.select("doc", "at", "rank"))
        known = depths[-1].withColumn("goes_on", F.lit(True))
        for part in closed:
            known = known.unionByName(part.select("doc", "at", "rank", F.lit(False).alias("goes_on")))
        onward = known.select("doc", (F.col("at") - h).alias("at"), F.col("rank").alias("second"), "goes_on")
        state = work.save(open_.withColumnRenamed("rank", "first").join(onward, ["doc", "at"], "left").withColumn("second", F.coalesce("second", F.lit(-1))), "state")
        placed = running(state.groupBy("first", "second").agg(F.count("*").alias("n")), ["first", "second"], "n", "pairs", work.save)
        base = placed.groupBy("first").agg(F.min("before").alias("base"))
        ranks = placed.join(base, "first").select("first", "second", (F.col("n") > 1).alias("several"), (F.col("first") + F.col("before") - F.col("base")).alias("rank"))
        moved = work.save(state.join(ranks, ["first", "second"]).select("doc", "id", "at", "rank", (F.col("several") & F.coalesce("goes_on", F.lit(False))).alias("goes_on")), "depth")
        work.drop(state)
        closed.append(moved.filter("not goes_on").drop("goes_on"))
        open_ = moved.filter("goes_on").drop("goes_on")
        h *= 2
    every = work.spark.createDataFrame([], "doc long, id long, at int, rank long")
    for part in closed:
        every = every.unionByName(part)
    return every, depths


def common_prefixes(array: DataFrame, depths: list[DataFrame], work: Workspace) -> DataFrame:
    """The suffix array (doc, id, at) with pos, its place in it, and above and below, the lines it shares with the place before and after."""
    order = ["rank", "id", "doc", "at"]
    placed = running(array.withColumn("n", F.lit(1)), order, "n", "array", work.save)
    rows = work.save(placed.select("doc", "id", "at", F.col("before").alias("pos")), "places")
    after = rows.select((F.col("pos") - 1).alias("pos"), F.col("doc").alias("doc2"), F.col("at").alias("at2"))
    pairs = work.save(rows.select("pos", "doc", "at").join(after, "pos").withColumn("lcp", F.lit(0)), "pairs")
    for k in reversed(range(len(depths))):
        one = depths[k].select("doc", F.col("at").alias("a"), F.col("rank").alias("r"))
        two = depths[k].select(F.col("doc").alias("doc2"), F.col("at").alias("a2"), F.col("rank").alias("r2"))
        held = pairs.withColumns({"a": F.col("at") + F.col("lcp"), "a2": F.col("at2") + F.col("lcp")}).join(one, ["doc", "a"], "left").join(two, ["doc2", "a2"], "left")
        more = F.when(F.col("r") == F.col("r2"), 2**k).otherwise(0)
        before, pairs = pairs, work.save(held.select("pos", "doc", "at", "doc2", "at2", (F.col("lcp") + more).alias("lcp")), "pairs")
        work.drop(before)
    below = pairs.select("pos", F.col("lcp").alias("below"))
    above = pairs.select((F.col("pos") + 1).alias("pos"), F.col("lcp").alias("above"))
    none = F.lit(0)
    return rows.join(below, "pos", "left").join(above, "pos", "left").withColumns({"above": F.coalesce("above", none), "below": F.coalesce("below", none)})


def repeated_places(lines: DataFrame, work: Workspace, least_lines: int = LEAST_LINES) -> tuple[DataFrame, DataFrame]:
    """(doc, at) of every place that starts a later copy of least_lines lines, and (doc, longest): the longest run it has in common with any other place.

    lines: (doc, id, at, high, low), at counting from 0 within doc, id the order of documents.
    """
    array, depths = suffix_ranks(lines, work)
    rows = work.save(common_prefixes(array, depths, work), "prefixes")
    longest = rows.groupBy("doc").agg(F.max(F.greatest("above", "below")).alias("longest"))
    copies = rows.filter(F.greatest("above", "below") >= least_lines).withColumn("starts", (F.col("above") < least_lines).cast("int"))
    marked = running(copies, ["pos"], "starts", "intervals", work.save).withColumn("interval", F.col("before") + F.col("starts"))
    firsts = marked.groupBy("interval").agg(F.min(F.struct("id", "doc", "at")).alias("p")).select("interval", F.col("p.doc").alias("fd"), F.col("p.at").alias("fa"))
    return marked.join(firsts, "interval").filter("doc <> fd or at <> fa").select("doc", "at"), longest


def line_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_lines: int = LEAST_LINES) -> DataFrame:
    """One row per document: doc_id, text without later copies, n_lines, n_removed, n_runs (maximal deleted runs), longest (lines of the longest run found elsewhere too)."""
    work = Workspace(docs.sparkSession, "lines")
    held = work.save(docs.select(F.monotonically_increasing_id().alias("doc"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), "held")
    places = held.select("doc", F.coalesce("doc_id", F.lit(LAST)).alias("id"), F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    lines = work.save(places.select("doc", "id", "at", F.xxhash64("line").alias("high"), F.xxhash64(F.lit("other half"), "line").alias("low")), "lines")
    later, longest = repeated_places(lines, work, least_lines)
    windows = F.sequence(F.col("at"), F.col("at") + (least_lines - 1))
    of = longest.join(later.groupBy("doc").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list(windows)))).alias("gone")), "doc", "left")
    of = work.save(of, "gone")
    work.only(held, of)
    size = of.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size(F.coalesce("gone", F.array().cast("array<int>")))), F.lit(0)).alias("lines")).first()
    both = held.join(sized(of, 1, 64 * size["n"] + 8 * size["lines"]), "doc", "left")
    parts, none = F.split("text", "\n", -1), F.array().cast("array<int>")
    gone = F.coalesce("gone", none)
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), gone)
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get(F.col("parts"), i)), "\n"))
    starts = F.filter(gone, lambda x, i: (i == 0) | (F.coalesce(F.get(gone, i - 1), F.lit(-9)) != x - 1))
    return both.withColumn("parts", parts).select(
        "doc_id", kept.alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("parts")).cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_removed"), F.size(starts).cast("long").alias("n_runs"), F.coalesce("longest", F.lit(0)).cast("long").alias("longest"),
    )
