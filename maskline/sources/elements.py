"""Records as one long element table, and the fixtures built from the driver's tables, each with its DuckDB twin.

elements: file_id, path (enclosing sequence, '' at the top), seq (order in the file), grp, elem, keyword, vr, vals array<string>.
boxes: file_id, idx, text, x1, y1, x2, y2, confidence, on a frame of FRAME x FRAME.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FRAME = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Text that fires one pattern per residue of the order key, in expressions that both engines know.
FREE_TEXT = """CASE o_orderkey % 10
 WHEN 0 THEN concat('MRN:', CAST(o_orderkey AS STRING))
 WHEN 1 THEN concat('DR. ', c_name)
 WHEN 2 THEN concat(lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0'), ' ', lpad(CAST(o_custkey % 10000 AS STRING), 4, '0'), ' 1234')
 WHEN 3 THEN concat('12-', lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0'), '-', lpad(CAST(o_custkey % 10000 AS STRING), 4, '0'), '-5678')
 WHEN 4 THEN concat('call 9', lpad(CAST(o_orderkey AS STRING), 9, '0'))
 WHEN 5 THEN concat('seen ', substr(DAY8, 7, 2), '-', substr(DAY8, 5, 2), '-', substr(DAY8, 1, 4))
 WHEN 6 THEN concat(substr(DAY8, 1, 4), '-', substr(DAY8, 5, 2), '-', substr(DAY8, 7, 2))
 WHEN 7 THEN concat(CAST(o_orderkey % 90 AS STRING), ' /M')
 WHEN 8 THEN concat('ACC-', CAST(o_orderkey AS STRING))
 ELSE CASE WHEN o_orderkey % 20 = 9 THEN 'CHEST PA' ELSE concat('L', CAST(o_orderkey % 30 AS STRING), ' ERECT') END END"""

#: (path, group, element, keyword, representation, value): one value, or two with a backslash between.
ROWS = [
    ("", 0x0010, 0x0010, "PatientName", "PN", "c_name"),
    ("", 0x0010, 0x0020, "PatientID", "LO", "CAST(o_custkey AS STRING)"),
    ("", 0x0010, 0x2150, "CountryOfResidence", "LO", "n_name"),
    ("", 0x0008, 0x0050, "AccessionNumber", "SH", "CAST(o_orderkey AS STRING)"),
    ("", 0x0008, 0x0020, "StudyDate", "DA", "DAY8"),
    ("", 0x0008, 0x1030, "StudyDescription", "LO", "o_orderpriority"),
    ("", 0x0020, 0x000D, "StudyInstanceUID", "UI", "concat('1.2.826.', CAST(o_orderkey AS STRING))"),
    ("", 0x0008, 0x0060, "Modality", "CS", "o_orderstatus"),
    ("", 0x0009, 0x0010, "", "LO", "c_mktsegment"),
    ("", 0x0040, 0x0244, "PerformedProcedureStepStartDate", "DA", "DAY8"),
    ("", 0x0020, 0x4000, "ImageComments", "LT", FREE_TEXT),
    ("", 0x0010, 0x1001, "OtherPatientNames", "PN", "concat(c_name, '\\', c_mktsegment)"),
    ("0010,1002[0]", 0x0010, 0x0020, "PatientID", "LO", "CAST(o_custkey AS STRING)"),
    ("", 0x0020, 0x0010, "StudyID", "SH", "CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE concat('S', CAST(o_orderkey % 1000 AS STRING)) END"),
    ("", 0x6000, 0x3000, "", "OW", "'overlay'"),
    ("", 0x0038, 0x4000, "VisitComments", "LT", "concat('Seen ', c_name)"),
    ("", 0x0010, 0x1000, "OtherPatientIDs", "LO", "concat('A', CAST(o_custkey AS STRING), '\\', CAST(o_orderkey AS STRING))"),
]


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per order: orders with their customer and nation, unpivoted in one pass."""
    base = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    base = base.join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    base = base.withColumn("DAY8", F.date_format("o_orderdate", "yyyyMMdd"))
    spell = lambda sql: sql.replace("'\\'", "'\\\\'")  # noqa: E731  a backslash is escaped in this engine's strings only
    structs = [
        F.struct(F.lit(p).alias("path"), F.lit(k).alias("seq"), F.lit(g).alias("grp"), F.lit(e).alias("elem"), F.lit(w).alias("keyword"), F.lit(vr).alias("vr"), F.expr(spell(v)).alias("value"))
        for k, (p, g, e, w, vr, v) in enumerate(ROWS)
    ]
    long = base.select(F.col("o_orderkey").alias("file_id"), F.explode(F.array(*structs)).alias("x")).select("file_id", "x.*")
    return long.withColumn("vals", F.split("value", r"\\", -1)).drop("value")


ELEMENTS_SQL = (
    "base AS (SELECT *, strftime(o_orderdate, '%Y%m%d') AS DAY8 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),\n"
    "elements AS (" + "\nUNION ALL ".join(
        f"SELECT o_orderkey AS file_id, '{p}' AS path, {k} AS seq, {g} AS grp, {e} AS elem, '{w}' AS keyword, '{vr}' AS vr, string_split({v}, '\\') AS vals FROM base"
        for k, (p, g, e, w, vr, v) in enumerate(ROWS)) + ")"
)

BOX = """l_orderkey AS file_id, CAST(l_linenumber AS BIGINT) * 10000000 + l_partkey * 100 + l_suppkey % 100 AS idx,
 CASE l_partkey % 6 WHEN 0 THEN 'CHEST PA' WHEN 1 THEN concat('NAME ', CAST(l_suppkey AS STRING)) WHEN 2 THEN concat('L', CAST(l_linenumber AS STRING)) WHEN 3 THEN CAST(l_orderkey AS STRING) WHEN 4 THEN '' ELSE concat('note ', CAST(l_partkey % 9 AS STRING)) END AS text,
 CAST((l_partkey * 37) % 300 + (l_linenumber % 3) * 40 AS INT) AS x1, CAST(l_linenumber * 55 + l_partkey % 60 AS INT) AS y1,
 CAST((l_partkey * 37) % 300 + (l_linenumber % 3) * 40 + CASE WHEN l_partkey % 50 = 0 THEN 0 WHEN l_partkey % 97 = 0 THEN 960 ELSE 30 + l_partkey % 200 END AS INT) AS x2,
 CAST(l_linenumber * 55 + l_partkey % 60 + CASE WHEN l_partkey % 83 = 0 THEN 420 ELSE 12 + l_suppkey % 60 END AS INT) AS y2,
 CAST((50 + l_partkey % 50) AS DOUBLE) / 100 AS confidence"""


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*[c.strip() for c in _split_columns(BOX)])


def _split_columns(sql: str) -> list[str]:
    out, depth, at = [], 0, 0
    for k, c in enumerate(sql):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(sql[at:k])
            at = k + 1
    return [*out, sql[at:]]


BOXES_SQL = f"boxes AS (SELECT {BOX} FROM lineitem)"


def tag_snapshot(elements_: DataFrame) -> DataFrame:
    """What a snapshot of a file's tags keeps: all but sequences, binary values and pixels."""
    keep = ~F.col("vr").isin("SQ", "OB", "OW", "UN")
    return elements_.filter(keep).select("file_id", F.format_string("(%04X,%04X)", "grp", "elem").alias("tag"), "keyword", "vr", F.array_join("vals", "\\").alias("value"))


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("file_id long, tag string, keyword string, vr string, value string").json(path)


def input_files(spark: SparkSession, folder: str, pattern: str = "*.dcm") -> DataFrame:
    """Files of a folder, of its subfolders only where it has none itself, in path order; contents are not read."""
    read = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    top = read.load(folder).select("path", "length", "modificationTime")
    if top.isEmpty():
        top = read.option("recursiveFileLookup", "true").load(folder).select("path", "length", "modificationTime")
    return top.orderBy("path")
