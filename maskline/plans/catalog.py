"""The engine's queries over the driver's tables, each with its DuckDB twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing, masking, text
from ..operators import cascade, geometry, pixels, policy, report, vault
from ..sources.elements import BOXES_SQL, ELEMENTS_SQL, FRAME, ROWS, boxes, elements, table, tag_snapshot

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
#: Test keys; production keys come from a key table.
KEY, SALT, MASTER, PREFIX = "k1", "0123456789abcdef", "00112233445566778899aabbccddeeff", "key:"


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return add


# SQL pieces

WIDTHS = "CASE vr " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in hashing.VR_WIDTH.items()) + " ELSE NULL END"
POLICY_SQL = "policy(grp, elem, technique) AS (VALUES " + ", ".join(f"({g}, {e}, '{t}')" for g, e, t in policy.fixed_rows()) + ")"
UID_IN = "(printf('%04X,%04X', grp, elem) IN (" + ", ".join(f"'{t}'" for t in policy.UID_TAGS) + "))"
SKIP = lambda v: f"({v} IS NULL OR trim({v}) = '' OR lower(trim({v})) = 'nan')"
DIGEST = lambda v, k: f"sha256({k} || sha256({k} || {v}))"
UID = lambda d: f"('2.25.' || CAST(CAST('0x' || substr({d}, 1, 32) AS UHUGEINT) AS VARCHAR))"


def sql_list(items) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in items)


def mask_sql(v: str, pattern: str) -> str:
    return (f"array_to_string(list_transform(list_zip(string_split_regex({v}, '{pattern}'), list_append(regexp_extract_all({v}, '{pattern}'), '')), "
            "lambda p: p[1] || repeat('*', length(p[2]))), '')")


def scrub_steps(source: str, column: str) -> str:
    """CTEs s0.. that scrub column of source, pattern by pattern."""
    out, last = [], source
    for k, p in enumerate(text.SCRUB_PATTERNS):
        out.append(f"s{k} AS (SELECT * REPLACE ({mask_sql(column, p)} AS {column}) FROM {last})")
        last = f"s{k}"
    return ", ".join(out)


TOKENS = "regexp_extract_all({u}, '[A-Z0-9]+')"


def clinical_sql(t: str) -> str:
    u = f"upper(trim({t}))"
    toks = TOKENS.format(u=u)
    known = sql_list(dict.fromkeys(text.ALLOWED + text.ALSO_TOKENS))
    return (f"(regexp_matches({u}, '{text.SIDE_MARK}') OR regexp_replace({u}, '[^A-Z0-9]', '', 'g') IN ({sql_list(text.ALLOWED + text.WHOLE)}) "
            f"OR (len({toks}) > 0 AND len(list_filter({toks}, lambda w: NOT (w IN ({known}) OR regexp_matches(w, '{text.LEVEL}')))) = 0))")


def pure_sql(t: str) -> str:
    toks = TOKENS.format(u=f"upper(trim({t}))")
    return f"(len(list_filter({toks}, lambda w: NOT (w IN ({sql_list(dict.fromkeys(text.PURE))}) OR regexp_matches(w, '^\\d{{1,4}}$') OR regexp_matches(w, '{text.LEVEL_OR_LETTER}')))) = 0)"


def merging_sql(t: str) -> str:
    u = f"upper(trim({t}))"
    toks = TOKENS.format(u=u)
    known = sql_list(dict.fromkeys(text.ALLOWED + text.ALSO_TOKENS + ["CXR"]))
    return (f"({u} = '' OR regexp_matches({u}, '{text.SIDE_MARK}') OR {u} IN ({sql_list(text.ALLOWED + text.WHOLE_MERGING)}) "
            f"OR (len({toks}) > 0 AND len(list_filter({toks}, lambda w: NOT (w IN ({known}) OR regexp_matches(w, '{text.LEVEL}')))) = 0))")


def demographic_sql(t: str) -> str:
    u = f"upper({t})"
    return "(" + " OR ".join(f"contains({u}, '{x}')" for x in text.DEMOGRAPHIC) + f" OR regexp_matches({u}, '\\bID\\b'))"


def found_sql(t: str) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN regexp_matches({t}, '(?i){p}') THEN 'regex:{n}' END" for n, p in text.PATTERNS.items()) + "], lambda r: r IS NOT NULL)"


TEXTS_SQL = f"{ELEMENTS_SQL}, texts AS (SELECT file_id, vals[1] AS text FROM elements WHERE keyword = 'ImageComments')"


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return elements(spark, sf_dir).filter("keyword = 'ImageComments'").select("file_id", F.element_at("vals", 1).alias("text"))


# 1. Hashes


@query("SELECT c_custkey, sha256(c_name) AS digest FROM customer")
def sha256_value(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", hashing.sha256(F.col("c_name")).alias("digest"))


@query(f"WITH e AS (SELECT c_custkey, c_name, unnest(['LO', 'SH', 'CS', 'ZZ']) AS vr FROM customer) SELECT c_custkey, vr, substr({DIGEST('c_name', repr(KEY))}, 1, coalesce({WIDTHS}, 64)) AS hashed FROM e")
def keyed_hash_vr(spark, sf_dir):
    e = table(spark, sf_dir, "customer").withColumn("vr", F.explode(F.array(*map(F.lit, ("LO", "SH", "CS", "ZZ")))))
    return e.select("c_custkey", "vr", hashing.keyed_hash(F.col("c_name"), F.col("vr"), F.lit(KEY)).alias("hashed"))


@query(f"WITH {ELEMENTS_SQL}, d AS (SELECT *, sha256('{SALT}' || vals[1]) AS d FROM elements WHERE vals[1] <> '') "
       f"SELECT file_id, seq, CASE WHEN vr = 'UI' OR {UID_IN} THEN {UID('d')} ELSE substr(d, 1, coalesce({WIDTHS}, 64)) END AS hashed FROM d")
def salted_hash_vr(spark, sf_dir):
    e = elements(spark, sf_dir).withColumn("v", F.element_at("vals", 1)).filter("v <> ''")
    return e.select("file_id", "seq", hashing.salted_hash(F.col("v"), F.col("vr"), (F.col("vr") == "UI") | policy.is_uid(), SALT).alias("hashed"))


@query(f"SELECT o_orderkey, {UID(DIGEST('CAST(o_orderkey AS VARCHAR)', repr(KEY)))} AS uid FROM orders")
def uid_remap(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", hashing.keyed_uid(F.col("o_orderkey").cast("string"), F.lit(KEY)).alias("uid"))


def _pads() -> tuple[str, str]:
    key = MASTER.encode().ljust(64, b"\0")
    return tuple(bytes(b ^ x for b in key).hex() for x in (0x36, 0x5C))


@query(f"SELECT c_custkey, substr(sha256(unhex('{_pads()[1]}') || unhex(sha256(unhex('{_pads()[0]}') || encode('col:' || CAST(c_custkey AS VARCHAR))))), 1, 32) AS subkey FROM customer")
def hmac_subkey(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", hashing.subkey(MASTER, F.concat(F.lit("col:"), F.col("c_custkey").cast("string"))).alias("subkey"))


# 2. Masks


@query("SELECT p_partkey, CASE WHEN length(p_name) >= 3 THEN substr(p_name, 1, 1) || '#' || '#' || substr(p_name, 4) ELSE substr(p_name, 1, 1) || repeat('#', length(p_name) - 1) END AS masked FROM part WHERE length(p_name) > 0")
def mask_at_positions(spark, sf_dir):
    return table(spark, sf_dir, "part").filter("length(p_name) > 0").select("p_partkey", masking.mask_positions(F.col("p_name"), (2, 3, 400), "#").alias("masked"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y') || '0000' AS masked FROM orders")
def date_mask_year(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", masking.mask_date(F.date_format("o_orderdate", "yyyyMMdd")).alias("masked"))


_ODD = "CASE c_custkey % 6 WHEN 0 THEN '' WHEN 1 THEN '   ' WHEN 2 THEN 'NaN' WHEN 3 THEN ' nan ' WHEN 4 THEN NULL ELSE c_name END"


@query(f"WITH v AS (SELECT c_custkey, {_ODD} AS v FROM customer) SELECT c_custkey, {SKIP('v')} AS skipped FROM v")
def skip_guard(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", masking.skip_value(F.expr(_ODD)).alias("skipped"))


@query(f"WITH {ELEMENTS_SQL}, w AS (SELECT *, repeat(vals[1], 3) AS v FROM elements) SELECT file_id, seq, CASE WHEN {WIDTHS} IS NULL THEN v ELSE substr(v, 1, {WIDTHS}) END AS fitted FROM w")
def vr_fit(spark, sf_dir):
    return elements(spark, sf_dir).select("file_id", "seq", hashing.fit_to_vr(F.repeat(F.element_at("vals", 1), F.lit(3)), F.col("vr")).alias("fitted"))


@query("SELECT c_custkey, regexp_replace(regexp_replace(c_name, '[0-9]', '0', 'g'), '[A-Za-z]', 'X', 'g') AS masked FROM customer")
def fixed_class_mask(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", masking.mask_class(F.col("c_name"), "0", "X").alias("masked"))


@query("SELECT c_custkey, regexp_replace(c_name, '#[^#]{2}', '#**', 'g') AS after_mark, regexp_replace(c_name, '[^#]{2}#', '**#', 'g') AS before_mark FROM customer")
def delimiter_mask(spark, sf_dir):
    name = F.col("c_name")
    return table(spark, sf_dir, "customer").select("c_custkey", masking.mask_around(name, "#", 2, True).alias("after_mark"), masking.mask_around(name, "#", 2, False).alias("before_mark"))


@query("SELECT c_custkey, CASE WHEN contains(c_name, '#') THEN regexp_replace(c_name, '#.*$', '') || '#' || regexp_extract(c_name, '#(.)(.*)$', 1) || repeat('*', length(regexp_extract(c_name, '#(.)(.*)$', 2))) ELSE c_name END AS masked FROM customer")
def group_mask(spark, sf_dir):
    from ..functions.ciphers import mask_groups_udf

    return table(spark, sf_dir, "customer").select("c_custkey", mask_groups_udf(masking.derived_pattern("after", "#"), [(1, "partial")])(F.col("c_name")).alias("masked"))


@query("SELECT p_partkey, substr(regexp_replace(p_name, '[^A-Za-z0-9_-]', '_', 'g'), 1, 64) AS stem FROM part WHERE p_name <> ''")
def safe_stems(spark, sf_dir):
    return table(spark, sf_dir, "part").filter("p_name <> ''").select("p_partkey", masking.safe_stem(F.col("p_name")).alias("stem"))


@query(f"WITH {ELEMENTS_SQL} SELECT file_id, seq, grp AS parsed_grp, elem AS parsed_elem FROM elements")
def printed_tags(spark, sf_dir):
    e = elements(spark, sf_dir).withColumn("tag", F.concat(F.lit("("), F.format_string("%04X, %04X", "grp", "elem"), F.lit(")")))
    return e.select("file_id", "seq", masking.parse_tag(F.col("tag"), 1).alias("parsed_grp"), masking.parse_tag(F.col("tag"), 2).alias("parsed_elem"))


# 3. Tag predicates

CATEGORY_SQL = """CASE WHEN vr = 'TM' THEN 'time' WHEN vr = 'DA' THEN 'date' WHEN vr = 'AS' OR keyword = 'PatientAge' THEN 'age' WHEN keyword = 'AccessionNumber' THEN 'accession'
 WHEN contains(lower(keyword), 'weight') THEN 'weight' WHEN contains(lower(keyword), 'description') THEN 'description' WHEN contains(lower(keyword), 'address') THEN 'address'
 WHEN keyword NOT LIKE '%UID' AND (keyword LIKE '%ID' OR keyword LIKE '%IDs') THEN 'id' WHEN vr = 'PN' OR contains(lower(keyword), 'name') THEN 'name' END"""


@query(f"WITH {ELEMENTS_SQL}, c AS (SELECT *, {CATEGORY_SQL} AS category FROM elements WHERE trim(array_to_string(vals, '\\')) NOT IN ('', 'None')) SELECT category, count(*) AS n, count(DISTINCT file_id) AS files FROM c WHERE category IS NOT NULL GROUP BY category")
def phi_tag_categories(spark, sf_dir):
    shown = masking.trimmed(F.array_join("vals", "\\"))
    e = elements(spark, sf_dir).filter(~shown.isin("", "None")).withColumn("category", text.tag_category(F.col("keyword"), F.col("vr")))
    return e.filter("category is not null").groupBy("category").agg(F.count("*").alias("n"), F.countDistinct("file_id").alias("files"))


@query(f"WITH {ELEMENTS_SQL} SELECT DISTINCT keyword, (keyword NOT LIKE '%UID' AND (keyword LIKE '%ID' OR keyword LIKE '%IDs')) AS is_id, CASE WHEN vr IN ('DA', 'DT') THEN 'mask' WHEN contains(lower(keyword), 'date') THEN 'suppress' ELSE 'none' END AS date_rule FROM elements")
def keyword_rules(spark, sf_dir):
    rule = F.coalesce(text.date_fallback(F.col("keyword"), F.col("vr")), F.lit("none"))
    return elements(spark, sf_dir).select("keyword", text.keyword_is_id(F.col("keyword")).alias("is_id"), rule.alias("date_rule")).distinct()


@query(f"WITH {ELEMENTS_SQL} SELECT file_id, count_if(grp % 2 = 1) AS private_tags, count_if(grp BETWEEN 24576 AND 24606 AND grp % 2 = 0) AS overlay_tags FROM elements GROUP BY file_id")
def private_and_overlay_tags(spark, sf_dir):
    overlay = (F.col("grp") >= 0x6000) & (F.col("grp") <= 0x601E) & (F.col("grp") % 2 == 0)
    return elements(spark, sf_dir).groupBy("file_id").agg(F.count_if(F.col("grp") % 2 == 1).alias("private_tags"), F.count_if(overlay).alias("overlay_tags"))


@query(f"WITH {ELEMENTS_SQL}, s AS (SELECT file_id, trim(array_to_string(vals, '\\')) AS value, keyword, vr FROM elements WHERE vr NOT IN ('SQ', 'OB', 'OW', 'UN')) "
       f"SELECT file_id, keyword, value FROM s WHERE length(value) >= 3 AND value <> 'None' AND vr <> 'UI' AND keyword NOT LIKE '%UID' AND NOT {clinical_sql('value')}")
def snapshot_values(spark, sf_dir):
    return geometry.stored_values(tag_snapshot(elements(spark, sf_dir))).select("file_id", "keyword", "value")


# 4. Rewrites

JOINED_SQL = (f"{ELEMENTS_SQL}, {POLICY_SQL}, j AS (SELECT e.*, grp % 2 = 1 AS is_private, CASE WHEN grp % 2 = 1 THEN 'suppress' WHEN p.technique IS NOT NULL THEN p.technique WHEN vr IN ('DA', 'DT') THEN 'mask' "
              "WHEN contains(lower(keyword), 'date') THEN 'suppress' END AS technique FROM elements e LEFT JOIN policy p USING (grp, elem))")
_KEYED = DIGEST("v", f"'{PREFIX}' || keyword")


_SHAPE = "regexp_replace(regexp_replace(regexp_replace({0}, '[A-Z]', 'A'{1}), '[a-z]', 'a'{1}), '[0-9]', '0'{1})"


def _shape(c):
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[A-Z]", "A"), "[a-z]", "a"), "[0-9]", "0")


#: The text the fixed policy works on: several values are a printed list.
_LIST = "trim(CASE WHEN len(vals) > 1 THEN '[' || array_to_string(list_transform(vals, lambda v: chr(39) || v || chr(39)), ', ') || ']' ELSE vals[1] END)"


@query(f"""WITH {JOINED_SQL}, x AS (SELECT * EXCLUDE (vals), array_to_string(vals, '\\') AS was, {_LIST} AS v FROM j WHERE technique IS NULL OR technique <> 'suppress'), {scrub_steps('x', 'v')},
tok AS (SELECT v, row_number() OVER (ORDER BY min((file_id, seq))) AS n FROM x WHERE technique = 'tokenise' GROUP BY v),
y AS (SELECT x.file_id, x.seq, x.path, x.keyword, x.technique, x.was, x.v, {SKIP('x.v')} AS skip, tok.n, s7.v AS scrubbed, {DIGEST('x.v', repr(PREFIX) + ' || x.keyword')} AS d, x.vr, x.grp, x.elem FROM x JOIN s7 USING (file_id, seq) LEFT JOIN tok ON x.technique = 'tokenise' AND tok.v = x.v),
z AS (SELECT *, CASE WHEN technique IS NULL OR technique = 'retain' OR skip THEN was WHEN technique = 'hash' AND ({UID_IN} OR vr = 'UI') THEN {UID('d')} WHEN technique = 'hash' THEN substr(d, 1, coalesce({WIDTHS}, 64))
 WHEN technique = 'mask' THEN substr(v, 1, 4) || '0000' || substr(v, 9) WHEN technique = 'scrub' THEN scrubbed WHEN technique = 'tokenise' THEN 'TK-' || printf('%06d', n) END AS value FROM y)
SELECT file_id, seq, path, keyword, value, CASE WHEN technique = 'charcloak' THEN {_SHAPE.format('was', ", 'g'")} END AS shape,
 CASE WHEN technique IN ('hash', 'charcloak', 'tokenise') AND NOT skip THEN true WHEN technique IN ('mask', 'scrub') THEN value <> was ELSE false END AS changed FROM z""")
def fixed_policy_rewrite(spark, sf_dir):
    """What the fixed policy leaves; of values drawn at random the shape, and for all whether they differ from what they were."""
    e, p = elements(spark, sf_dir), policy.fixed_policy(spark)
    done = policy.fixed_rewrite(e.withColumn("was", F.array_join("vals", "\\")), p, PREFIX, policy.mint_tokens(e, p), MASTER)
    value, drawn = F.array_join("vals", "\\"), F.col("keyword") == "VisitComments"
    return done.select("file_id", "seq", "path", "keyword", F.when(~drawn, value).alias("value"), F.when(drawn, _shape(value)).alias("shape"), (value != F.col("was")).alias("changed"))


AUDIT_SQL = f"""{JOINED_SQL}, audit AS (SELECT file_id, seq, printf('(%04X,%04X)', grp, elem) AS tag, CASE WHEN is_private THEN '(private)' ELSE keyword END AS field, technique,
 CASE WHEN is_private THEN 'deleted-private-tag' WHEN technique = 'suppress' THEN 'deleted' WHEN {SKIP("array_to_string(vals, chr(92))")} THEN 'skipped-empty' WHEN technique = 'retain' THEN 'retained' ELSE 'transformed' END AS action FROM j WHERE technique IS NOT NULL)"""


@query(f"WITH {AUDIT_SQL} SELECT * FROM audit")
def fixed_policy_audit(spark, sf_dir):
    return policy.fixed_audit(elements(spark, sf_dir), policy.fixed_policy(spark))


JOB = policy.parse_job({"dicom_deidentify": {"tag_actions": {
    "PatientName": {"action": "masking", "masking_char": "#", "characters_to_mask": [1, 2, 5]}, "PatientID": {"action": "hashing_with_salt"},
    "StudyDescription": {"action": "suppress"}, "OtherPatientNames": {"action": "hashing_with_salt"}, "StudyDate": {"action": "masking", "characters_to_mask": [5, 6, 7, 8]},
    "Modality": {"action": "keep"}, "NoSuchKeyword": {"action": "suppress"}}}})
_AT = lambda v, c, *ps: "(" + " || ".join(f"CASE WHEN {k} IN ({', '.join(map(str, ps))}) AND length({v}) >= {k} THEN '{c}' ELSE substr({v}, {k}, 1) END" for k in range(1, 9)) + f" || substr({v}, 9))"


@query(f"""WITH {ELEMENTS_SQL}, x AS (SELECT * EXCLUDE (vals), unnest(vals) AS v, generate_subscripts(vals, 1) AS k FROM elements WHERE grp % 2 = 0),
y AS (SELECT * EXCLUDE (v), CASE WHEN keyword = 'StudyDescription' THEN '' WHEN {SKIP('v')} THEN v WHEN keyword = 'PatientName' THEN {_AT('v', '#', 1, 2, 5)}
 WHEN keyword IN ('PatientID', 'OtherPatientNames') THEN substr(sha256('{SALT}' || v), 1, 64) WHEN keyword = 'StudyDate' THEN {_AT('v', '*', 5, 6, 7, 8)}
 WHEN {UID_IN} THEN {UID(_KEYED)} ELSE v END AS v FROM x)
SELECT file_id, seq, any_value(keyword) AS keyword, string_agg(v, '\\' ORDER BY k) AS value FROM y GROUP BY file_id, seq""")
def config_policy_rewrite(spark, sf_dir):
    done = policy.config_rewrite(elements(spark, sf_dir), JOB, SALT, MASTER, PREFIX)
    return done.select("file_id", "seq", "keyword", F.array_join("vals", "\\").alias("value"))


@query(f"""WITH {ELEMENTS_SQL}, a AS (SELECT *, {SKIP("array_to_string(vals, chr(92))")} AS empty, CASE WHEN keyword IN ('PatientName', 'StudyDate') THEN 'masking' WHEN keyword IN ('PatientID', 'OtherPatientNames') THEN 'hashing_with_salt'
 WHEN keyword = 'StudyDescription' THEN 'suppress' END AS act FROM elements)
SELECT file_id, seq, printf('(%04X,%04X)', grp, elem) AS tag, CASE WHEN grp % 2 = 1 THEN '(private)' ELSE keyword END AS field,
 CASE WHEN grp % 2 = 1 THEN 'private_tag_policy' WHEN act IS NULL THEN 'uid_policy' ELSE act END AS technique,
 CASE WHEN grp % 2 = 1 THEN 'deleted-private-tag' WHEN act IS NULL THEN 'remapped' WHEN act = 'suppress' THEN 'blanked' WHEN empty THEN 'skipped-empty' ELSE 'transformed' END AS action,
 grp % 2 = 1 OR act IS NULL OR act = 'suppress' OR NOT empty AS changed FROM a WHERE grp % 2 = 1 OR act IS NOT NULL OR ({UID_IN} AND NOT empty)""")
def config_policy_audit(spark, sf_dir):
    return policy.config_audit(elements(spark, sf_dir), JOB)


@query(f"""WITH {AUDIT_SQL}, k AS (SELECT file_id, seq, '(0010,0010)' AS tag, 'PatientName' AS field, 'preserved' AS technique, 'kept' AS action, false AS changed FROM j WHERE keyword = 'PatientName' AND path = '')
SELECT file_id, seq, tag, field, technique, action, action NOT IN ('skipped-empty', 'retained') AS changed, '' AS value FROM audit WHERE tag <> '(0010,0010)'
UNION ALL SELECT k.*, array_to_string(j.vals, '\\') FROM k JOIN j USING (file_id, seq)""")
def preserve_tags(spark, sf_dir):
    """The audit with a preserved tag, and that tag's value after the rewrite and its restoration."""
    e, p = elements(spark, sf_dir), policy.fixed_policy(spark)
    audit = policy.preserve_audit(policy.fixed_audit(e, p), e, ["PatientName"])
    rewritten = policy.fixed_rewrite(e, p, PREFIX, policy.mint_tokens(e, p), MASTER)
    kept = policy.preserve(e, rewritten, ["PatientName"]).filter("keyword = 'PatientName' and path = ''").select("file_id", "seq", F.array_join("vals", "\\").alias("value"))
    return audit.join(kept, ["file_id", "seq"], "left").withColumn("value", F.coalesce("value", F.lit("")))


@query(f"SELECT o_orderkey AS file_id, {UID(DIGEST('CAST(o_orderkey AS VARCHAR)', repr(KEY)))} AS header_uid FROM orders")
def meta_uid_sync(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("file_id"), F.col("o_orderkey").cast("string").alias("uid"))
    main = o.select("file_id", F.lit("main").alias("scope"), F.lit("SOPInstanceUID").alias("keyword"), F.array(hashing.keyed_uid(F.col("uid"), F.lit(KEY))).alias("vals"))
    meta = o.select("file_id", F.lit("meta").alias("scope"), F.lit("MediaStorageSOPInstanceUID").alias("keyword"), F.array("uid").alias("vals"))
    done = policy.sync_header(main.unionByName(meta)).filter("scope = 'meta'")
    return done.select("file_id", F.element_at("vals", 1).alias("header_uid"))


# 5. Text


@query(f"WITH {TEXTS_SQL} SELECT " + ", ".join(f"count_if(regexp_matches(text, '(?i){p}')) AS {n}" for n, p in text.PATTERNS.items()) + " FROM texts")
def pii_pattern_flags(spark, sf_dir):
    return texts(spark, sf_dir).agg(*[F.count_if(text.has_pattern(F.col("text"), n)).alias(n) for n in text.PATTERNS])


#: Patterns without classes that the two engines see differently in scripts other than Latin.
_FLAGGED = ("aadhaar", "abha", "phone", "date", "uhid_mrn", "age_sex", "name_prefix", "accession")


@query("SELECT doc_id, " + ", ".join(f"regexp_matches(regexp_replace(text, '[^\\x00-\\x7F]', '_', 'g'), '(?i){text.PATTERNS[n]}') AS {n}" for n in _FLAGGED) + " FROM documents")
def document_pattern_flags(spark, sf_dir):
    """All patterns over whole documents; characters beyond ASCII stand as word characters, which both engines read alike."""
    plain = table(spark, sf_dir, "documents").withColumn("text", F.regexp_replace("text", r"[^\x00-\x7F]", "_"))
    return plain.select("doc_id", *[text.has_pattern(F.col("text"), n).alias(n) for n in _FLAGGED])


@query(f"WITH {TEXTS_SQL}, {scrub_steps('texts', 'text')} SELECT file_id, text AS scrubbed FROM s7")
def scrub_free_text(spark, sf_dir):
    return texts(spark, sf_dir).select("file_id", masking.scrub(F.col("text"), text.SCRUB_PATTERNS).alias("scrubbed"))


@query(f"WITH {BOXES_SQL} SELECT file_id, idx, {demographic_sql('text')} AS label, {clinical_sql('text')} AS clinical, {pure_sql('text')} AS pure, {merging_sql('text')} AS merging, regexp_matches(trim(text), '{text.EXPOSURE}') AS exposure FROM boxes")
def text_tests(spark, sf_dir):
    t = F.col("text")
    return boxes(spark, sf_dir).select("file_id", "idx", text.has_demographic_label(t).alias("label"), text.is_clinical(t).alias("clinical"), text.is_pure_clinical(t).alias("pure"),
                                       text.is_clinical_for_merging(t).alias("merging"), masking.trimmed(t).rlike("(?U)" + text.EXPOSURE).alias("exposure"))


CASCADE_SQL = f"""{TEXTS_SQL}, r AS (SELECT file_id, trim(text) AS t FROM texts), f AS (SELECT *, {found_sql('t')} AS found FROM r), d AS (SELECT file_id, t, found,
 CASE WHEN {clinical_sql('t')} OR {pure_sql('t')} THEN 'clinical:allowlist' WHEN {demographic_sql('t')} THEN 'simultaneous_matrix:phi_detected(' || array_to_string(list_prepend('regex:demographic_label', found), ',') || ')'
 WHEN len(found) = 0 AND regexp_matches(t, '{text.EXPOSURE}') THEN 'clinical:exposure_number' WHEN len(found) = 0 AND NOT regexp_matches(t, '[A-Za-z]') THEN 'fallback:numeric_non_phi'
 WHEN len(found) > 0 THEN 'simultaneous_matrix:phi_detected(' || array_to_string(found, ',') || ')' ELSE 'fallback:unclassified_text' END AS reason FROM f)"""


@query(f"WITH {CASCADE_SQL} SELECT file_id, reason, reason LIKE '%phi_detected%' OR reason = 'fallback:unclassified_text' AS redact FROM d WHERE t <> ''")
def rule_cascade(spark, sf_dir):
    return cascade.classify(texts(spark, sf_dir)).select("file_id", "reason", "redact")


# 6. Vault and ciphers

_NUMBERED = "row_number() OVER (PARTITION BY c_nationkey ORDER BY first_key)"


@query(f"""WITH s AS (SELECT CAST(c_nationkey AS VARCHAR) AS "column", CAST(o_custkey AS VARCHAR) AS value, c_nationkey, min(o_orderkey) AS first_key FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
SELECT "column", value, 'TK-' || printf('%06d', {_NUMBERED}) AS token FROM s""")
def token_vault_first_seen(spark, sf_dir):
    new = vault.extend(spark.createDataFrame([], vault.SCHEMA), _seen(spark, sf_dir), "o_orderkey")
    return new.select("column", "value", vault.token(F.col("number")).alias("token"))


def _seen(spark, sf_dir) -> DataFrame:
    both = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return both.select(F.col("c_nationkey").cast("string").alias("column"), F.col("o_custkey").cast("string").alias("value"), "o_orderkey")


@query(f"""WITH s AS (SELECT CAST(c_nationkey AS VARCHAR) AS "column", CAST(o_custkey AS VARCHAR) AS value, c_nationkey, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey),
a AS (SELECT "column", value, c_nationkey, min(CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END) AS early, min(o_orderkey) AS late FROM s GROUP BY ALL)
SELECT "column", value, 'TK-' || printf('%06d', row_number() OVER (PARTITION BY c_nationkey ORDER BY early IS NULL, coalesce(early, late))) AS token FROM a""")
def token_vault_append(spark, sf_dir):
    seen = _seen(spark, sf_dir)
    first = vault.extend(spark.createDataFrame([], vault.SCHEMA), seen.filter("o_orderkey % 2 = 0"), "o_orderkey")
    every = first.unionByName(vault.extend(first, seen, "o_orderkey"))
    return vault.look_up(seen.select("column", "value").distinct(), every).select("column", "value", "token")


@query(f"SELECT c_custkey, {_SHAPE.format('c_name', ", 'g'")} AS shape, true AS round_trip, true AS changed FROM customer")
def fpe_shape(spark, sf_dir):
    from ..functions.ciphers import fpe_udf

    c = table(spark, sf_dir, "customer").withColumn("e", fpe_udf(MASTER, "PatientName")(F.col("c_name")))
    return c.select("c_custkey", _shape(F.col("e")).alias("shape"), (fpe_udf(MASTER, "PatientName", True)(F.col("e")) == F.col("c_name")).alias("round_trip"), (F.col("e") != F.col("c_name")).alias("changed"))


@query(f"SELECT c_custkey, {_SHAPE.format('c_name', ", 'g'")} AS shape FROM customer")
def charcloak_shape(spark, sf_dir):
    from ..functions.ciphers import random_class_udf

    return table(spark, sf_dir, "customer").select("c_custkey", _shape(random_class_udf()(F.col("c_name"))).alias("shape"))


@query(f"WITH {ELEMENTS_SQL} SELECT file_id, seq, CASE WHEN vr = 'UI' THEN 'uid' WHEN vr = 'CS' OR vr = 'SH' THEN 'cut' WHEN vr IN ('DA') THEN 'eight' ELSE 'whole' END AS kind FROM elements WHERE vals[1] <> '' AND vr <> 'OW'")
def random_token_shape(spark, sf_dir):
    from ..functions.ciphers import random_token_udf

    e = elements(spark, sf_dir).withColumn("v", F.element_at("vals", 1)).filter("v <> '' and vr <> 'OW'")
    t = e.withColumn("t", random_token_udf()(F.col("v"), F.col("vr"), (F.col("vr") == "UI") | policy.is_uid()))
    kind = (F.when(F.col("t").rlike(r"^2\.25\.\d+$"), "uid").when(F.col("t").rlike("^TK-[0-9A-F]{13}$"), "cut")
            .when(F.col("t").rlike("^TK-[0-9A-F]{5}$"), "eight").when(F.col("t").rlike("^TK-[0-9A-F]{32}$"), "whole"))
    return t.select("file_id", "seq", kind.alias("kind"))


@query("SELECT c_custkey, 4 + 2 * strlen(c_name) AS size, c_name AS back FROM customer")
def xor_roundtrip(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn("e", hashing.xor_encrypt(F.col("c_name"), MASTER, "PatientName"))
    return c.select("c_custkey", F.length("e").cast("long").alias("size"), hashing.xor_decrypt(F.col("e"), MASTER, "PatientName").alias("back"))


# 7. Boxes

_INTER = "greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1))"
_AREA = lambda t: f"(({t}.x2 - {t}.x1) * ({t}.y2 - {t}.y1))"
PAIRS_SQL = f"""{BOXES_SQL}, p AS (SELECT a.file_id, a.idx AS i, b.idx AS j, {_INTER} AS inter, {_AREA('a')} AS aa, {_AREA('b')} AS ab FROM boxes a JOIN boxes b ON a.file_id = b.file_id AND a.idx < b.idx
 AND a.x1 < b.x2 AND b.x1 < a.x2 AND a.y1 < b.y2 AND b.y1 < a.y2), m AS (SELECT file_id, i, j, CASE WHEN aa + ab - inter > 0 THEN CAST(inter AS DOUBLE) / (aa + ab - inter) ELSE 0 END AS iou,
 CAST(inter AS DOUBLE) / greatest(aa, 1) AS a_in_b, CAST(inter AS DOUBLE) / greatest(ab, 1) AS b_in_a FROM p)"""


@query(f"WITH {PAIRS_SQL} SELECT *, iou > 0.3 OR a_in_b > 0.7 OR b_in_a > 0.7 AS merge FROM m")
def box_overlap_pairs(spark, sf_dir):
    return geometry.overlapping_pairs(boxes(spark, sf_dir))


@query(f"WITH {BOXES_SQL} SELECT file_id, idx FROM boxes WHERE NOT (y2 - y1 > {FRAME} * 0.40 OR x2 - x1 > {FRAME} * 0.95 OR (x2 - x1) * (y2 - y1) > {FRAME * FRAME} * 0.30)")
def size_gate(spark, sf_dir):
    return geometry.size_gate(boxes(spark, sf_dir), FRAME, FRAME).select("file_id", "idx")


_LAST = ", ".join(f"lag({c}) OVER o AS p{c}" for c in geometry.BOX)
BLOCKS_SQL = f"""{BOXES_SQL}, g AS (SELECT *, {_LAST} FROM boxes WINDOW o AS (PARTITION BY file_id ORDER BY y1, idx)),
h AS (SELECT *, CASE WHEN py1 IS NULL OR (y1 - py2 <= 1.8 * greatest(py2 - py1, 1) AND CASE WHEN least(px2 - px1, x2 - x1) > 0 THEN CAST(greatest(0, least(px2, x2) - greatest(px1, x1)) AS DOUBLE) / least(px2 - px1, x2 - x1) ELSE 0 END >= 0.3) THEN 0 ELSE 1 END AS step FROM g),
blocks AS (SELECT *, CAST(sum(step) OVER (PARTITION BY file_id ORDER BY y1, idx ROWS UNBOUNDED PRECEDING) AS BIGINT) AS block FROM h)"""


@query(f"WITH {BLOCKS_SQL} SELECT file_id, idx, block FROM blocks")
def block_cluster(spark, sf_dir):
    return geometry.block_clusters(boxes(spark, sf_dir)).select("file_id", "idx", "block")


@query(f"""WITH {BLOCKS_SQL}, w AS (SELECT *, contains(text, 'NAME') AS phi FROM blocks), z AS (SELECT *, max(CAST(phi AS INT)) OVER b AS flagged, count(*) OVER b AS n FROM w WINDOW b AS (PARTITION BY file_id, block))
SELECT file_id, idx, phi OR (n >= 2 AND flagged = 1 AND NOT {clinical_sql('text')}) AS expanded FROM z""")
def block_expand(spark, sf_dir):
    return geometry.expand_blocks(boxes(spark, sf_dir).withColumn("is_phi", F.col("text").contains("NAME"))).select("file_id", "idx", "expanded")


_STORED = "stored AS (SELECT l_orderkey AS file_id, concat('name ', CAST(max(l_suppkey) AS VARCHAR)) AS value FROM lineitem GROUP BY 1 UNION ALL SELECT DISTINCT l_orderkey, CAST(l_orderkey AS VARCHAR) || 'X' FROM lineitem)"
MATCH_SQL = f"""{BOXES_SQL}, {_STORED}, hits AS (SELECT b.file_id, b.idx FROM boxes b WHERE length(trim(b.text)) >= 4 AND NOT {clinical_sql('b.text')} AND EXISTS (SELECT 1 FROM stored s WHERE b.file_id = s.file_id AND length(s.value) >= 3
 AND (upper(trim(b.text)) = upper(s.value) OR (length(s.value) >= 4 AND contains(upper(s.value), upper(trim(b.text)))) OR contains(upper(trim(b.text)), upper(s.value)))))"""


def _stored(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    names = li.groupBy(F.col("l_orderkey").alias("file_id")).agg(F.concat(F.lit("name "), F.max("l_suppkey").cast("string")).alias("value"))
    return names.unionByName(li.select(F.col("l_orderkey").alias("file_id"), F.concat(F.col("l_orderkey").cast("string"), F.lit("X")).alias("value")).distinct())


@query(f"WITH {MATCH_SQL} SELECT file_id, idx FROM hits")
def tag_text_match(spark, sf_dir):
    return geometry.tag_matches(boxes(spark, sf_dir), _stored(spark, sf_dir)).select("file_id", "idx")


@query(f"WITH {MATCH_SQL} SELECT b.file_id, b.idx FROM boxes b WHERE NOT EXISTS (SELECT 1 FROM hits h JOIN boxes c ON h.file_id = c.file_id AND h.idx = c.idx WHERE c.file_id = b.file_id AND c.x1 = b.x1 AND c.y1 = b.y1 AND c.x2 = b.x2 AND c.y2 = b.y2)")
def unmatched_rest(spark, sf_dir):
    b = boxes(spark, sf_dir)
    return geometry.unmatched(b, geometry.tag_matches(b, _stored(spark, sf_dir))).select("file_id", "idx")


@query(f"WITH {BOXES_SQL} SELECT file_id, idx, greatest(0, least(x1, x2) - 5) AS x1, greatest(0, least(y1, y2) - 5) AS y1, least({FRAME}, greatest(x1, x2) + 5) AS x2, least({FRAME}, greatest(y1, y2) + 5) AS y2 FROM boxes")
def quad_boxes(spark, sf_dir):
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    quad = F.array(corner("x1", "y1"), corner("x2", "y1"), corner("x2", "y2"), corner("x1", "y2"))
    return boxes(spark, sf_dir).select("file_id", "idx", geometry.quad_to_box(quad, FRAME, FRAME).alias("b")).select("file_id", "idx", "b.*")


@query(f"WITH {BOXES_SQL}, s AS (SELECT *, greatest(1.0::DOUBLE, least(4.0::DOUBLE, 48 / greatest(y2 - y1, 1)::DOUBLE)) AS scale FROM boxes) SELECT file_id, idx, round(scale, 9) AS scale, CAST(trunc(100 / scale) AS INT) + x1 AS back FROM s")
def crop_back_projection(spark, sf_dir):
    b = boxes(spark, sf_dir).withColumn("scale", geometry.crop_scale(F.col("y2") - F.col("y1")))
    return b.select("file_id", "idx", F.round("scale", 9).alias("scale"), geometry.back_project(F.lit(100), F.col("x1"), F.col("scale")).alias("back"))


# 8. Order-dependent merges: no SQL form


@query()
def greedy_merge(spark, sf_dir):
    return geometry.greedy_merge(boxes(spark, sf_dir))


@query()
def line_merge(spark, sf_dir):
    return geometry.line_merge(boxes(spark, sf_dir))


@query()
def merge_detections(spark, sf_dir):
    return geometry.merge_detections(boxes(spark, sf_dir))


@query()
def region_cluster(spark, sf_dir):
    return geometry.region_clusters(boxes(spark, sf_dir))


# 9. Reports


@query(f"WITH {AUDIT_SQL} SELECT file_id, technique, count(*) AS n FROM audit WHERE action NOT IN ('skipped-empty', 'retained') GROUP BY file_id, technique")
def manifest_by_technique(spark, sf_dir):
    audit = policy.fixed_audit(elements(spark, sf_dir), policy.fixed_policy(spark)).withColumn("changed", F.lit(True))
    return report.by_technique(audit).select("file_id", F.explode("tags_by_technique").alias("technique", "n"))


@query("SELECT event_type AS status, count(*) AS n FROM events GROUP BY event_type")
def status_histogram(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("status")).agg(F.count("*").alias("n"))


_SPOT = lambda q: f"list_sort(list(value))[CAST(least(count(value) - 1, round_even({q} * (count(value) - 1), 0)) AS BIGINT) + 1]"


@query(f"SELECT event_type AS stage, count(value) AS n, round(avg(value), 6) AS mean, {_SPOT(0.5)} AS p50, {_SPOT(0.9)} AS p90, {_SPOT(0.99)} AS p99, max(value) AS max, round(sum(value), 4) AS sum FROM events GROUP BY event_type")
def stage_stats(spark, sf_dir):
    out = report.statistics(table(spark, sf_dir, "events").withColumnRenamed("event_type", "stage"), "value", "stage")
    return out.select("stage", F.col("n").cast("long"), F.round("mean", 6).alias("mean"), "p50", "p90", "p99", "max", F.round("sum", 4).alias("sum"))


@query("SELECT user_id, round(count(*) * 60 / sum(value), 6) AS files_per_minute, round(sum(value) / count(*), 6) AS seconds_per_file FROM events GROUP BY user_id HAVING sum(value) > 0")
def throughput(spark, sf_dir):
    g = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("files"), F.sum("value").alias("seconds")).filter("seconds > 0")
    return g.select("user_id", *[F.round(c, 6).alias(n) for c, n in zip(report.throughput(F.col("files"), F.col("seconds")), ("files_per_minute", "seconds_per_file"))])


@query("""WITH p AS (SELECT p_partkey, CAST(p_size * 3 AS BIGINT) AS cpus, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_retailprice * 40 AS BIGINT) END AS mb, CAST(1 + p_partkey % 9 AS BIGINT) AS files FROM part),
w AS (SELECT *, greatest(1, least(cpus // 8, CASE WHEN mb IS NULL THEN cpus // 8 ELSE CAST(floor((mb - 5012) / 1500) AS BIGINT) END, files)) AS workers FROM p)
SELECT p_partkey, CAST(workers AS INT) AS workers, CAST(greatest(1, cpus // workers) AS INT) AS threads FROM w""")
def worker_plan(spark, sf_dir):
    p = table(spark, sf_dir, "part").selectExpr("p_partkey", "CAST(p_size * 3 AS BIGINT) AS cpus", "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(bround(p_retailprice * 40) AS BIGINT) END AS mb", "CAST(1 + p_partkey % 9 AS BIGINT) AS files")
    return p.select("p_partkey", *report.worker_plan(F.col("cpus"), F.col("mb"), F.col("files")))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS path FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag <> 'R')")
def resume_todo(spark, sf_dir):
    inputs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("path"))
    done = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("path"), F.when(F.col("l_returnflag") == "R", "failed").alias("error"))
    return report.resume(inputs, done)


@query("SELECT p_partkey, CASE WHEN k = 1 THEN stem ELSE stem || '_' || CAST(k AS VARCHAR) END AS name FROM (SELECT p_partkey, regexp_replace(p_brand, '[^A-Za-z0-9_-]', '_', 'g') AS stem, row_number() OVER (PARTITION BY regexp_replace(p_brand, '[^A-Za-z0-9_-]', '_', 'g') ORDER BY p_partkey) AS k FROM part)")
def unique_names(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("path"), masking.safe_stem(F.col("p_brand")).alias("stem"))
    return report.unique_names(p).select(F.col("path").alias("p_partkey"), "name")


_CHEST = """p_partkey, p_size % 7 > 0 AS has_rows, CASE WHEN p_partkey % 11 = 0 THEN 'PR' WHEN p_partkey % 13 = 0 THEN '' ELSE 'CR' END AS modality, CASE WHEN p_partkey % 4 = 0 THEN 'HAND' WHEN p_partkey % 9 = 0 THEN '' ELSE 'chest' END AS body,
 CASE WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 5 = 0 THEN p_type ELSE 'Chest PA' END AS study, CASE WHEN p_partkey % 7 = 0 THEN 'left knee AP' ELSE 'erect' END AS series"""
_REASON = f"""CASE WHEN NOT has_rows OR modality = 'PR' THEN 'not an image object (Modality=' || CASE WHEN modality = '' THEN 'none' ELSE modality END || ')' WHEN upper(body) <> 'CHEST' THEN 'BodyPartExamined=' || CASE WHEN body = '' THEN 'empty' ELSE upper(body) END
 WHEN study <> '' AND NOT contains(upper(study), 'CHEST') THEN 'StudyDescription does not mention CHEST (' || substr(upper(study), 1, 60) || ')' WHEN regexp_matches(upper(series), '{text.OTHER_ANATOMY}') THEN 'SeriesDescription names other anatomy (' || regexp_extract(upper(series), '{text.OTHER_ANATOMY}') || ')'
 ELSE 'image; BodyPartExamined=CHEST; descriptions consistent' END"""


@query(f"WITH c AS (SELECT {_CHEST} FROM part), r AS (SELECT *, {_REASON} AS reason FROM c) SELECT p_partkey, reason, reason LIKE 'image;%' AS is_chest FROM r")
def chest_decision(spark, sf_dir):
    return report.chest(_chest_rows(spark, sf_dir)).select("p_partkey", "reason", "is_chest")


def _chest_rows(spark, sf_dir):
    return spark.sql(f"SELECT {_CHEST} FROM {{part}}", part=table(spark, sf_dir, "part"))


@query(f"WITH c AS (SELECT {_CHEST} FROM part), r AS (SELECT *, {_REASON} AS reason FROM c) SELECT split_part(split_part(reason, ' (', 1), '=', 1) AS reason_key, count(*) AS n FROM r WHERE NOT reason LIKE 'image;%' GROUP BY 1")
def reason_histogram(spark, sf_dir):
    rows = report.chest(_chest_rows(spark, sf_dir)).filter("not is_chest")
    return rows.groupBy(text.reason_key(F.col("reason")).alias("reason_key")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, 'out/' || CAST(o_custkey AS VARCHAR) || '/' || CAST(o_orderkey AS VARCHAR) || '.dcm' AS mirrored, 'out/f' || CAST(o_orderkey AS VARCHAR) || '/' || CAST(o_orderkey AS VARCHAR) || '.dcm' AS own FROM orders")
def output_paths(spark, sf_dir):
    path = F.concat(F.lit("/"), F.col("o_custkey").cast("string"), F.lit("/"), F.col("o_orderkey").cast("string"), F.lit(".dcm"))
    name = F.concat(F.lit("f"), F.col("o_orderkey").cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", report.output_path(path, "out").alias("mirrored"), report.output_path(path, "out/", "per-file", name).alias("own"))


@query("SELECT CAST(o_orderkey AS VARCHAR) || '.dcm' AS path FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 1)")
def selection_siblings(spark, sf_dir):
    files = table(spark, sf_dir, "orders").select(F.concat(F.col("o_orderkey").cast("string"), F.lit(".dcm")).alias("path"))
    images = table(spark, sf_dir, "lineitem").filter("l_linenumber = 1").select(F.concat(F.col("l_orderkey").cast("string"), F.lit(".jpg")).alias("path"))
    return report.with_sibling(files, images)


_STATE = "CASE WHEN a AND NOT e THEN 'PASSED' WHEN s THEN 'PASSED (Escalated)' ELSE 'FAILED' END"
_FLAGS = "p_partkey, p_partkey % 2 = 0 AS a, p_partkey % 3 = 0 AS e, p_partkey % 5 > 1 AS s, p_partkey % 7 > 0 AS px, p_partkey % 4 > 0 AS geo, CASE WHEN p_partkey % 11 = 0 THEN 3 ELSE 1 END AS samples"


@query(f"WITH f AS (SELECT {_FLAGS} FROM part) SELECT p_partkey, {_STATE} AS status, CASE WHEN px AND samples > 1 THEN 'error: colour' WHEN px THEN 'image' WHEN geo THEN 'error: geometry without pixels' ELSE 'metadata only' END AS presence FROM f")
def verification_states(spark, sf_dir):
    f = table(spark, sf_dir, "part").selectExpr(*[c.strip() for c in _FLAGS.split(", ")])
    return f.select("p_partkey", pixels.verification(F.col("a"), F.col("e"), F.col("s")).alias("status"), pixels.pixel_presence(F.col("px"), F.col("geo"), F.col("samples")).alias("presence"))


_PIVOT = list(dict.fromkeys(w or f"({g:04X},{e:04X})" for p, g, e, w, _, _ in ROWS if not p))


@query(f"WITH {ELEMENTS_SQL}, c AS (SELECT file_id, CASE WHEN keyword <> '' THEN keyword ELSE printf('(%04X,%04X)', grp, elem) END AS name, CASE WHEN vr = 'OW' THEN '<' || CAST(strlen(array_to_string(vals, '\\')) AS VARCHAR) || ' bytes>' ELSE array_to_string(vals, '\\') END AS cell FROM elements WHERE path = '') "
       "SELECT file_id, " + ", ".join(f"max(cell) FILTER (WHERE name = '{c}') AS \"{c}\"" for c in _PIVOT) + " FROM c GROUP BY file_id")
def tag_inventory_pivot(spark, sf_dir):
    return report.inventory(elements(spark, sf_dir), _PIVOT)


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n, max(value) AS peak FROM events GROUP BY 1, 2")
def monitor_timeline(spark, sf_dir):
    from ..streaming.ingest import timeline

    return timeline(table(spark, sf_dir, "events"), "1 hour")


# 10. Pixels

FRAMES_SQL = "frames AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1000) AS BIGINT) + 5000) AS px FROM embeddings)"


def frames(spark, sf_dir):
    px = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000) + 5000)
    return table(spark, sf_dir, "embeddings").select("vec_id", px.alias("px"))


_STRETCH = "CASE WHEN hi > lo THEN list_transform(px, lambda x: CAST(floor(least(greatest((x - lo) / (hi - lo), 0.0), 1.0) * 255) AS INT)) ELSE list_transform(px, lambda x: 0) END"


def _AT_SQL(q: float) -> str:
    spot = f"(CAST({q} AS DOUBLE) * (len(s) - 1))"
    low = f"CAST(floor({spot}) AS INT)"
    return f"(s[{low} + 1] + (s[least({low} + 2, len(s))] - s[{low} + 1]) * ({spot} - {low}))"


@query(f"WITH {FRAMES_SQL}, o AS (SELECT *, list_sort(px) AS s FROM frames), q AS (SELECT *, {_AT_SQL(0.01)} AS lo, {_AT_SQL(0.99)} AS hi FROM o) SELECT vec_id, array_to_string({_STRETCH}, ',') AS stretched FROM q")
def percentile_stretch(spark, sf_dir):
    return frames(spark, sf_dir).select("vec_id", F.array_join(pixels.percentile_stretch(F.col("px")).cast("array<string>"), ",").alias("stretched"))


@query(f"WITH {FRAMES_SQL}, q AS (SELECT *, list_min(px) AS lo, list_max(px) AS hi FROM frames) SELECT vec_id, array_to_string({_STRETCH}, ',') AS stretched FROM q")
def minmax_8bit(spark, sf_dir):
    return frames(spark, sf_dir).select("vec_id", F.array_join(pixels.minmax_stretch(F.col("px")).cast("array<string>"), ",").alias("stretched"))


@query(f"WITH {FRAMES_SQL} SELECT vec_id, array_to_string(list_transform(px, lambda x: list_max(px) - x), ',') AS inverted FROM frames")
def photometric_invert(spark, sf_dir):
    return frames(spark, sf_dir).select("vec_id", F.array_join(pixels.invert(F.col("px")).cast("array<string>"), ",").alias("inverted"))


@query(f"WITH {FRAMES_SQL} SELECT vec_id, array_to_string(list_transform(range(len(px)), lambda i: CASE WHEN i % 8 >= 2 AND i % 8 < 5 AND i // 8 >= 1 AND i // 8 < 4 THEN list_min(px) ELSE px[i + 1] END), ',') AS filled FROM frames")
def black_fill(spark, sf_dir):
    box = [F.lit(x) for x in (2, 1, 5, 4)]
    return frames(spark, sf_dir).select("vec_id", F.array_join(pixels.black_fill(F.col("px"), F.lit(8), *box).cast("array<string>"), ",").alias("filled"))


_DTYPE = "CASE p_partkey % 4 WHEN 0 THEN 'uint8' WHEN 1 THEN 'uint16' WHEN 2 THEN 'int16' ELSE 'float32' END"


@query(f"WITH p AS (SELECT p_partkey, {_DTYPE} AS t FROM part) SELECT p_partkey, CASE WHEN t = 'uint8' THEN 8 ELSE 16 END AS bits_allocated, CASE WHEN t = 'uint8' THEN 8 ELSE 16 END AS bits_stored, CASE WHEN t = 'uint8' THEN 7 ELSE 15 END AS high_bit, CASE WHEN t = 'int16' THEN 1 ELSE 0 END AS signed, CASE WHEN t = 'uint8' THEN 'OB' ELSE 'OW' END AS vr FROM p")
def pixel_descriptors(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", pixels.descriptors(F.expr(_DTYPE)).alias("d")).select("p_partkey", "d.*")


# 11. Streams


@query("""WITH s AS (SELECT event_type AS "column", CAST(user_id AS VARCHAR) AS value, min(struct_pack(a := ts, b := event_id)) AS k FROM events GROUP BY ALL)
SELECT "column", value, 'TK-' || printf('%06d', row_number() OVER (PARTITION BY "column" ORDER BY k)) AS token FROM s""")
def stream_ingest_tokens(spark, sf_dir):
    from ..sources.saved import new_folder
    from ..streaming.ingest import ingest

    root = new_folder(spark, "stream")
    events = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet" if _is_folder(spark, f"{sf_dir}/events.parquet") else f"{sf_dir}/events*")
    ingest(stream.select(F.col("event_type").alias("column"), F.col("user_id").cast("string").alias("value"), "ts", "event_id"), f"{root}/vault", f"{root}/checkpoint", "ts", "event_id")
    held = spark.read.schema("column string, value string, number long, batch long").parquet(f"{root}/vault")
    return held.select("column", "value", vault.token(F.col("number")).alias("token"))


def _is_folder(spark, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


# 12. Settings, masks by configuration, totals


def _expected(cases: dict[str, str]) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in cases.items()) + ") t(name, outcome)"


def _outcome(function) -> str:
    try:
        return str(function())
    except (ValueError, SystemExit) as wrong:
        return type(wrong).__name__


def _outcomes(spark: SparkSession, cases: dict) -> DataFrame:
    return spark.createDataFrame([(k, _outcome(f)) for k, f in cases.items()], "name string, outcome string")


@query(_expected({"no block": "fixed", "no block, off": "none", "block": "config", "list": "ValueError", "unknown operation": "ValueError", "operations as text": "ValueError",
                  "other default": "ValueError", "temp outside": "ValueError", "undeclared": "masking", "overruled": "pixel.fill,temp_dir", "unknown tag": "Nope", "missing file": "None", "kept tags": "Zip"}))
def job_outcomes(spark, sf_dir):
    """What becomes of job documents: the policy that runs, or why none does."""
    from ..operators import jobs

    block = {"tag_actions": {"PatientID": {"action": "masking", "characters_to_mask": [1]}, "Nope": {"action": "suppress"}}, "temp_dir": "/x", "pixel": {"fill": 1}}
    doc = {"dicom_deidentify": block, "operations": ["dicom_deidentify"]}
    of = lambda d, **k: jobs.selected_policy(jobs.check(d, **k))
    return _outcomes(spark, {
        "no block": lambda: of({}), "no block, off": lambda: jobs.selected_policy(jobs.check({}), False), "block": lambda: of(doc), "list": lambda: of([]),
        "unknown operation": lambda: of({**doc, "operations": ["date_shift"]}), "operations as text": lambda: of({**doc, "operations": "masking"}),
        "other default": lambda: of({"dicom_deidentify": {"default_action": "suppress"}}), "temp outside": lambda: of(doc, temp_dir="/data/tmp"),
        "undeclared": lambda: ",".join(jobs.check(doc).undeclared), "overruled": lambda: ",".join(jobs.check(doc, {"temp_dir": "/tmp/run", "pixel.fill": 0, "input_dir": "/in"}).overruled),
        "unknown tag": lambda: ",".join(jobs.check(doc).config.unresolved), "missing file": lambda: jobs.load("/nowhere/job.json"),
        "kept tags": lambda: ",".join(jobs.unknown_kept(["PatientID", "Zip"]))})


@query(_expected({"unset": "None", "number": "4", "zero": "SystemExit", "word": "SystemExit", "key": "32", "salt": "64", "same key": "True", "other column": "False", "other store": "False",
                  "titles": "a_b,a_b_2,a_b_3", "long titles": "31,30", "nested": "NAME 0.75", "flat": "NAME 0.9", "pairs": "NAME 0.9", "nothing": "[]"}))
def driver_rules(spark, sf_dir):
    """Settings read and made on the driver: environment, keys, sheet titles, recognisers' outputs."""
    from ..operators import jobs

    env, store, quad = {"A": " 4 ", "Z": "0", "W": "four"}, jobs.KeyStore(spark), [[0, 0], [1, 0], [1, 1], [0, 1]]
    shown = lambda r: " ".join(f"{t} {c}" for _, t, c in jobs.recognised(r))
    return _outcomes(spark, {
        "unset": lambda: jobs.environment_int("N", env), "number": lambda: jobs.environment_int("A", env), "zero": lambda: jobs.environment_int("Z", env), "word": lambda: jobs.environment_int("W", env),
        "key": lambda: len(jobs.new_key()), "salt": lambda: len(jobs.new_key(32)), "same key": lambda: store.get("hash", "PatientID") == store.get("hash", "PatientID"),
        "other column": lambda: store.get("hash", "PatientID") == store.get("hash", "StudyID"), "other store": lambda: store.get("hash", "PatientID") == store.get("fpe", "PatientID"),
        "titles": lambda: ",".join(jobs.sheet_titles(["x/a:b", "a/b/../a_b", "a?b"])), "long titles": lambda: ",".join(str(len(t)) for t in jobs.sheet_titles(["q" * 40] * 2)),
        "nested": lambda: shown([[[quad, ("NAME", 0.75)], [quad]]]), "flat": lambda: shown([(quad, "NAME", "high")]), "pairs": lambda: shown([[quad, "NAME"], [quad, 5]]), "nothing": lambda: jobs.recognised(None)})


@query("SELECT c_custkey, regexp_replace(regexp_replace(regexp_replace('*' || substr(c_name, 2), '0', '*', 'g'), '[1-9]', '9', 'g'), '[A-Za-z]', 'Q', 'g') AS masked, '*' || substr(c_name, 2, 5) || '##' || substr(c_name, 9) AS beside FROM customer")
def mask_steps(spark, sf_dir):
    """Masks by configuration: positions, then a pattern, then classes; and two characters before a mark, which leaves the pattern out."""
    from ..functions import steps

    all_three = steps.parse({"column": "c_name", "characters_to_mask": [1, 99], "regex_patterns": [{"regex": "0+"}], "class_masking_mode": "fixed_class", "class_mask_letter": "Q", "class_mask_digit": "9"})
    beside = steps.parse({"column": "c_name", "characters_to_mask": [1], "apply_order": ["regex", "characters"], "regex_patterns": [{"regex": "(", "type": "before", "delimiter": "#", "length": 2, "masking_char": "#"}]})
    return table(spark, sf_dir, "customer").select("c_custkey", all_three.udf()(F.col("c_name")).alias("masked"), beside.udf()(F.col("c_name")).alias("beside"))


@query("SELECT count(*) AS files, count_if(o_orderkey % 7 = 0) AS failed, sum(CAST(o_orderkey % 3 AS BIGINT)) AS n_redacted, sum(CAST(o_orderkey % 2 AS BIGINT)) AS n_matched, sum(o_custkey) AS bytes, 2 * count_if(o_orderkey % 5 > 0) AS tags_changed, max(CASE WHEN o_orderkey % 4 > 0 THEN o_custkey END) AS peak_mb FROM orders")
def run_totals(spark, sf_dir):
    from ..operators import jobs

    audits = table(spark, sf_dir, "orders").selectExpr("CAST(o_orderkey AS STRING) AS path", "CASE WHEN o_orderkey % 7 = 0 THEN 'bad' END AS error", "CAST(o_orderkey % 3 AS BIGINT) AS n_redacted", "CAST(o_orderkey % 2 AS BIGINT) AS n_matched",
                                                       "o_custkey AS bytes", "CASE WHEN o_orderkey % 5 > 0 THEN array(true, false, CAST(NULL AS BOOLEAN)) END AS changed", "CASE WHEN o_orderkey % 4 > 0 THEN o_custkey END AS peak_mb")
    return jobs.run_totals(audits)


@query(f"WITH {BOXES_SQL}, c AS (SELECT *, (y1 + y2) / 2.0 AS cy FROM boxes), n AS (SELECT *, CASE WHEN cy - lag(cy) OVER o > 8 THEN 1 ELSE 0 END AS new FROM c WINDOW o AS (PARTITION BY file_id ORDER BY cy, x1, idx)) "
       "SELECT file_id, idx, CAST(sum(new) OVER (PARTITION BY file_id ORDER BY cy, x1, idx ROWS UNBOUNDED PRECEDING) AS BIGINT) AS line FROM n")
def blob_lines(spark, sf_dir):
    from ..operators import jobs

    return jobs.blob_lines(boxes(spark, sf_dir)).select("file_id", "idx", "line")


@query(f"WITH {BOXES_SQL} SELECT DISTINCT file_id, x1, y1, x2, y2 FROM boxes")
def distinct_boxes(spark, sf_dir):
    from ..operators import jobs

    return jobs.distinct_boxes(boxes(spark, sf_dir))
