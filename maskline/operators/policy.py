"""Policy dimensions, the fixed and the configured rewrite of an element table, audits, kept tags and header sync."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import hashing, masking, text
from . import vault

#: The fixed policy, technique by technique, elements by group.
FIXED = {
    "suppress": {
        "0010": "0010 0021 0024 1001 0032 1040 2154 1060 2160 2180 1080 1081 2150 2152 21F0 2000 4000 1090",
        "0008": "0090 0092 0094 0096 1048 1050 1060 1070 1072 0080 0081 0082 0030 0031 0032 0033",
        "0032": "1032", "0040": "0006 1010 0275 0241 3001 A160 A123", "0038": "0021 0011 0300 0400 0500",
        "0018": "1000", "4008": "010C 0114 0119", "0400": "0561", "0012": "0010",
    },
    "hash": {
        "0010": "0020 1000 1002", "0008": "1010 0018 0058", "0020": "000D 000E 0052 0010 0200",
        "0040": "1001 0009 0253 2016 2017 A124", "0088": "0140", "0038": "0010 0060", "0018": "1002 700A", "0012": "0020 0040",
    },
    "retain": {"0010": "0040 1010 1020 1030", "0008": "1040 0016 0070 1090 1030 103E", "0032": "1060", "0040": "0254", "0018": "1020 1030"},
    "mask": {"0010": "0030 21D0", "0008": "0020 0021 0022 0023", "0038": "0020"},
    "scrub": {"0010": "2110 21B0", "0020": "4000"},
    "charcloak": {"0038": "4000", "0008": "2111"},
    "tokenise": {"0008": "0050"},
}
#: Tags whose values are identifiers and stay well-formed ones.
UID_TAGS = "0020,000D 0020,000E 0008,0018 0020,0052 0008,0058 0088,0140 0018,1002 0020,0200 0040,A124".split()
#: Representations that are blanked as null, not as empty text.
BINARY_VRS = "US SS UL SL FL FD OB OW OF UN AT".split()
ACTIONS = ("hashing_with_salt", "encrypt", "masking", "tokenization", "charcloak", "suppress")


def fixed_rows() -> list[tuple[int, int, str]]:
    return [(int(g, 16), int(e, 16), t) for t, groups in FIXED.items() for g, es in groups.items() for e in es.split()]


def fixed_policy(spark: SparkSession) -> DataFrame:
    """(grp, elem, technique): 104 rows, so it may be broadcast."""
    return spark.createDataFrame(fixed_rows(), "grp int, elem int, technique string")


def is_uid() -> Column:
    tags = [int(t[:4], 16) << 16 | int(t[5:], 16) for t in UID_TAGS]
    return (F.col("grp") * 65536 + F.col("elem")).isin(tags)


def in_dropped_sequence(path: Column, dropped: list[str]) -> Column:
    """Whether some enclosing sequence is private or one of the tags dropped."""
    tag = lambda step: F.substring(step, 1, 9)
    odd = lambda step: F.conv(F.substring(step, 1, 4), 16, 10).cast("int") % 2 == 1
    return (path != "") & F.exists(F.split(path, "/"), lambda s: tag(s).isin(dropped) | odd(s))


def joined(elements: DataFrame, policy: DataFrame) -> DataFrame:
    """elements with the fixed policy's decision: technique (null: left alone), is_private, dropped."""
    dropped = [f"{g:04X},{e:04X}" for g, e, t in fixed_rows() if t == "suppress"]
    both = elements.join(F.broadcast(policy), ["grp", "elem"], "left")
    return (
        both.withColumn("is_private", F.col("grp") % 2 == 1)
        .withColumn("technique", F.when(F.col("is_private"), "suppress").otherwise(F.coalesce("technique", text.date_fallback(F.col("keyword"), F.col("vr")))))
        .withColumn("inside", in_dropped_sequence(F.col("path"), dropped))
    )


def key_of(keyword: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), keyword)


#: Techniques that Column expressions carry out, and those drawn or encrypted by Arrow functions.
NATIVE, DRAWN = ("hash", "mask", "scrub", "encrypt"), ("charcloak", "encrypt_fpe")
#: Representations whose items have no quotes in the text form of a list.
UNQUOTED_VRS = "PN DS IS US SS UL SL FL FD".split()


def transform(technique: Column, value: Column, vr: Column, uid: Column, key: Column, column: Column, master: str) -> Column:
    """value under a technique whose result depends on the value and its column's key only."""
    hashed = F.when(uid, hashing.keyed_uid(value, key)).otherwise(hashing.keyed_hash(value, vr, key))
    return (
        F.when(technique == "hash", hashed).when(technique == "mask", masking.mask_date(value))
        .when(technique == "scrub", masking.scrub(value, text.SCRUB_PATTERNS)).when(technique == "encrypt", hashing.xor_encrypt(value, master, column))
    )


def list_text(vals: Column, vr: Column) -> Column:
    """The text that the fixed policy works on: the value, or the printed list where there are several."""
    item = lambda v: F.when(vr.isin(UNQUOTED_VRS), v).otherwise(F.concat(F.lit("'"), v, F.lit("'")))
    return F.when(F.size(vals) > 1, F.concat(F.lit("["), F.array_join(F.transform(vals, item), ", "), F.lit("]"))).otherwise(F.element_at(vals, 1))


def prepared(elements: DataFrame, policy: DataFrame) -> DataFrame:
    """What the fixed policy keeps, with its decision, column key, the trimmed text _v that it works on, and _skip."""
    now = joined(elements, policy).filter(~F.col("inside") & ~F.coalesce(F.col("technique") == "suppress", F.lit(False)))
    now = now.withColumn("_column", masking.column_key(F.col("keyword"), F.col("grp"), F.col("elem")))
    now = now.withColumn("_v", F.when(F.col("technique").isin(*NATIVE, *DRAWN, "tokenise"), masking.trimmed(list_text(F.col("vals"), F.col("vr")))))
    return now.withColumn("_skip", masking.skip_clean(F.col("_v")))


def mint_tokens(elements: DataFrame, policy: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """The vault (column, value, number) that fixed_rewrite needs: what is held, and new tokens in order of file and place."""
    held = elements.sparkSession.createDataFrame([], vault.SCHEMA) if held is None else held
    seen = prepared(elements, policy).filter((F.col("technique") == "tokenise") & ~F.col("_skip"))
    return held.unionByName(vault.extend(held, seen.select(F.col("_column").alias("column"), F.col("_v").alias("value"), "file_id", "seq"), "file_id", "seq"))


def fixed_rewrite(elements: DataFrame, policy: DataFrame, key, tokens: DataFrame, master: str) -> DataFrame:
    """Elements, all their columns, after the fixed policy; dropped ones are gone, changed ones have one value: several are turned to one text first.

    key: a prefix before the column, or a function from the column to its key. tokens: the vault (see mint_tokens); a value to be
    tokenised that it lacks raises an error, so no such value passes. master: the key that ciphers derive theirs from.
    """
    from ..functions.ciphers import fpe_column_udf, random_class_udf

    now, technique, column, value = prepared(elements, policy), F.col("technique"), F.col("_column"), F.col("_v")
    of = key_of(column, key) if isinstance(key, str) else key(column)
    t = tokens.select(F.col("column").alias("_c"), F.col("value").alias("_t"), vault.token(F.col("number")).alias("_token"))
    asked = F.when((technique == "tokenise") & ~F.col("_skip"), value)
    now = now.withColumn("_asked", asked).join(t, (F.col("_asked") == F.col("_t")) & (column == F.col("_c")), "left")
    # Python functions run on every row they are given: they get null where the technique is another
    only = lambda name: F.when((technique == name) & ~F.col("_skip"), value)
    done = F.coalesce(
        F.when(technique.isin(*NATIVE), transform(technique, value, F.col("vr"), is_uid() | (F.col("vr") == "UI"), of, column, master)),
        F.col("_token"), F.when(technique == "tokenise", F.raise_error(F.lit("a value to be tokenised has no token"))),
        random_class_udf()(only("charcloak")), fpe_column_udf(master)(only("encrypt_fpe"), column))
    now = now.withColumn("vals", F.when(technique.isin(*NATIVE, *DRAWN, "tokenise") & ~F.col("_skip"), F.array(done)).otherwise(F.col("vals")))
    return now.select(*elements.columns)


def fixed_audit(elements: DataFrame, policy: DataFrame) -> DataFrame:
    """(file_id, seq, tag, field, technique, action) of what the fixed policy did; never a value. An unknown technique does nothing."""
    empty = masking.skip_value(F.array_join("vals", "\\"))
    action = (
        F.when(F.col("is_private"), "deleted-private-tag").when(F.col("technique") == "suppress", "deleted").when(empty, "skipped-empty")
        .when(F.col("technique") == "retain", "retained").when(F.col("technique").isin(*NATIVE, *DRAWN, "tokenise"), "transformed").otherwise("unchanged")
    )
    kept = joined(elements, policy).filter(~F.col("inside") & F.col("technique").isNotNull())
    field_ = F.when(F.col("is_private"), "(private)").otherwise(F.col("keyword"))
    return kept.select("file_id", "seq", F.format_string("(%04X,%04X)", "grp", "elem").alias("tag"), field_.alias("field"), "technique", action.alias("action"))


def preserve_audit(audit: DataFrame, original: DataFrame, keywords: list[str]) -> DataFrame:
    """audit with the entries of kept tags replaced: each top-level element of these keywords is 'preserved', and unchanged."""
    kept = original.filter(F.col("keyword").isin(keywords) & (F.col("path") == ""))
    entry = kept.select("file_id", "seq", F.format_string("(%04X,%04X)", "grp", "elem").alias("tag"), F.col("keyword").alias("field"), F.lit("preserved").alias("technique"), F.lit("kept").alias("action"))
    rest = audit.join(entry.select("file_id", "tag").distinct(), ["file_id", "tag"], "left_anti").select(*entry.columns)
    return rest.withColumn("changed", ~F.col("action").isin("skipped-empty", "retained", "unchanged")).unionByName(entry.withColumn("changed", F.lit(False)))


@dataclass(frozen=True)
class TagAction:
    keyword: str
    grp: int
    elem: int
    action: str
    masking_char: str = "*"
    positions: tuple[int, ...] = ()
    format_preserving: bool = False


@dataclass
class JobConfig:
    actions: list[TagAction] = field(default_factory=list)
    unresolved: list[str] = field(default_factory=list)


#: Keywords a job may name, with their tags.
KEYWORDS = {
    "PatientName": "0010,0010", "PatientID": "0010,0020", "PatientBirthDate": "0010,0030", "PatientSex": "0010,0040", "PatientAge": "0010,1010",
    "PatientAddress": "0010,1040", "PatientTelephoneNumbers": "0010,2154", "PatientWeight": "0010,1030", "OtherPatientNames": "0010,1001",
    "EthnicGroup": "0010,2160", "InstitutionName": "0008,0080", "InstitutionAddress": "0008,0081", "ReferringPhysicianName": "0008,0090",
    "PerformingPhysicianName": "0008,1050", "OperatorsName": "0008,1070", "AccessionNumber": "0008,0050", "StudyDate": "0008,0020",
    "SeriesDate": "0008,0021", "AcquisitionDate": "0008,0022", "StudyDescription": "0008,1030", "SeriesDescription": "0008,103E",
    "Modality": "0008,0060", "Manufacturer": "0008,0070", "BodyPartExamined": "0018,0015", "StudyInstanceUID": "0020,000D",
    "SeriesInstanceUID": "0020,000E", "SOPInstanceUID": "0008,0018", "Rows": "0028,0010", "Columns": "0028,0011", "BitsAllocated": "0028,0100",
}


def parse_job(document: str | dict, dictionary: dict[str, str] | None = None) -> JobConfig:
    """A job's actions from its JSON; ValueError says what is wrong. Keywords without a tag are noted, not fatal."""
    doc = json.loads(document) if isinstance(document, str) else document
    if not isinstance(doc, dict) or not isinstance(doc.get("dicom_deidentify"), dict):
        raise ValueError("dicom_deidentify must be an object")
    block = doc["dicom_deidentify"]
    if block.get("default_action", "keep") != "keep":
        raise ValueError("default_action must be keep")
    listed = block.get("tag_actions", {})
    if not isinstance(listed, dict):
        raise ValueError("tag_actions must be an object")
    out, known = JobConfig(), {**(dictionary or {}), **KEYWORDS}
    for keyword, spec in listed.items():
        if not isinstance(spec, dict) or spec.get("action") not in (*ACTIONS, "keep"):
            raise ValueError(f"{keyword}: unknown action")
        places = spec.get("characters_to_mask", [])
        if not isinstance(places, list) or any(isinstance(p, bool) or not isinstance(p, int) or p < 1 for p in places):
            raise ValueError(f"{keyword}: characters_to_mask must be whole numbers from 1")
        if keyword not in known:
            out.unresolved.append(keyword)
        elif spec["action"] != "keep":
            grp, elem = (int(x, 16) for x in known[keyword].split(","))
            out.actions.append(TagAction(keyword, grp, elem, spec["action"], spec.get("masking_char", "*"), tuple(places), bool(spec.get("format_preserving", False))))
    return out


def config_decisions(elements: DataFrame, job: JobConfig) -> DataFrame:
    """elements with action (null: not listed), is_private, inside (a private or suppressed sequence)."""
    spark = elements.sparkSession
    dim = spark.createDataFrame([(a.grp, a.elem, a.action) for a in job.actions], "grp int, elem int, action string")
    dropped = [f"{a.grp:04X},{a.elem:04X}" for a in job.actions if a.action == "suppress"] or ["-"]
    both = elements.join(F.broadcast(dim), ["grp", "elem"], "left").withColumn("is_private", F.col("grp") % 2 == 1)
    return both.withColumn("inside", in_dropped_sequence(F.col("path"), dropped))


def config_rewrite(elements: DataFrame, job: JobConfig, salt: str, master: str, key_prefix: str) -> DataFrame:
    """Elements after a job's actions: private ones gone, suppressed ones blanked, listed ones rewritten, other identifiers remapped."""
    from ..functions.ciphers import fpe_udf, random_class_udf, random_token_udf

    now = config_decisions(elements, job).filter(~F.col("inside") & ~F.col("is_private"))
    column, uid = masking.column_key(F.col("keyword"), F.col("grp"), F.col("elem")), (F.col("vr") == "UI") | is_uid()

    def of(a: TagAction, v: Column) -> Column:
        if a.action == "hashing_with_salt":
            return hashing.salted_hash(v, F.col("vr"), uid, salt)
        if a.action == "masking":
            return masking.mask_positions(v, a.positions, a.masking_char)
        return hashing.xor_encrypt(v, master, a.keyword)

    def each(a: TagAction):
        return lambda v: F.when(masking.skip_value(v), v).otherwise(of(a, masking.trimmed(v)))

    vals = F.col("vals")
    for a in job.actions:
        here = (F.col("grp") == a.grp) & (F.col("elem") == a.elem)
        if a.action == "suppress":
            blank = F.when(F.col("vr").isin(BINARY_VRS), F.lit(None).cast("array<string>")).otherwise(F.array(F.lit("")))
            vals = F.when(here, blank).otherwise(vals)
        elif a.action in ("tokenization", "charcloak") or a.format_preserving:
            # Python functions run on every row they are given: they get null where the tag is another
            draw = {"tokenization": lambda x: random_token_udf()(x, F.col("vr"), uid), "charcloak": lambda x: random_class_udf()(x)}.get(a.action, lambda x: fpe_udf(master, a.keyword)(x))
            given = F.when(here, F.element_at(F.col("vals"), 1))
            vals = F.when(here & ~masking.skip_value(given), F.array(draw(given))).otherwise(vals)
        else:
            vals = F.when(here, F.transform("vals", each(a))).otherwise(vals)
    remap = F.transform("vals", lambda v: F.when(masking.skip_value(v), v).otherwise(hashing.keyed_uid(masking.trimmed(v), key_of(column, key_prefix))))
    vals = F.when(F.col("action").isNull() & is_uid(), remap).otherwise(vals)
    return now.select("file_id", "path", "seq", "grp", "elem", "keyword", "vr", vals.alias("vals"))


def config_audit(elements: DataFrame, job: JobConfig) -> DataFrame:
    """(file_id, seq, tag, field, technique, action, changed) of what a job did; never a value."""
    empty = masking.skip_value(F.array_join("vals", "\\"))
    policy = F.col("action").isNull() & is_uid() & ~empty
    rows = config_decisions(elements, job).filter(~F.col("inside") & (F.col("is_private") | F.col("action").isNotNull() | policy))
    technique = F.when(F.col("is_private"), "private_tag_policy").when(F.col("action").isNull(), "uid_policy").otherwise(F.col("action"))
    done = (
        F.when(F.col("is_private"), "deleted-private-tag").when(F.col("action").isNull(), "remapped").when(F.col("action") == "suppress", "blanked")
        .when(empty, "skipped-empty").otherwise("transformed")
    )
    field_ = F.when(F.col("is_private"), "(private)").otherwise(F.col("keyword"))
    return rows.select("file_id", "seq", F.format_string("(%04X,%04X)", "grp", "elem").alias("tag"), field_.alias("field"), technique.alias("technique"), done.alias("action"),
                       (F.col("is_private") | F.col("action").isNull() | (F.col("action") == "suppress") | ~empty).alias("changed"))


def preserve(original: DataFrame, rewritten: DataFrame, keywords: list[str]) -> DataFrame:
    """rewritten with the original top-level elements of these keywords in place of what the policy made of them."""
    mine = F.col("keyword").isin(keywords) & (F.col("path") == "")
    return rewritten.filter(~mine).unionByName(original.filter(mine).select(*rewritten.columns))


def sync_header(rows: DataFrame, scope: str = "scope") -> DataFrame:
    """The header's instance identifier set to the (possibly remapped) one of the record itself, per file."""
    own = F.max(F.when((F.col(scope) == "main") & (F.col("keyword") == "SOPInstanceUID"), F.element_at("vals", 1))).over(W.partitionBy("file_id"))
    here = (F.col(scope) == "meta") & (F.col("keyword") == "MediaStorageSOPInstanceUID")
    return rows.withColumn("_own", own).withColumn("vals", F.when(here & F.col("_own").isNotNull(), F.array("_own")).otherwise(F.col("vals"))).drop("_own")


def will_change(elements: DataFrame, policy: DataFrame, kept: list[str]) -> DataFrame:
    """elements that the fixed policy alters or deletes, except kept keywords."""
    now = joined(elements, policy)
    return now.filter((F.col("inside") | F.col("is_private") | (F.col("technique").isNotNull() & (F.col("technique") != "retain"))) & ~F.col("keyword").isin(kept or ["-"]))
