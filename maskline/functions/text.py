"""Text rules: personal-data patterns, demographic labels, clinical vocabularies, tag categories, chest selection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import bind
from .masking import trimmed

#: Named personal-data patterns; matched without regard to case as flags, with regard to it when scrubbing.
PATTERNS = {
    "aadhaar": r"\b\d{4}\s?\d{4}\s?\d{4}\b",
    "abha": r"\b\d{2}-\d{4}-\d{4}-\d{4}\b",
    "phone": r"\b(?:\+91|0)?[6-9]\d{9}\b",
    "date": r"\b\d{1,2}[-/.]\d{1,2}[-/.]\d{2,4}\b|\b\d{4}[-/.]\d{1,2}[-/.]\d{1,2}\b",
    "uhid_mrn": r"\b(?:UHID|MRN|REG|IPD|OPD|CR|PID|HID)[\s:/-]?\d+\b",
    "age_sex": r"\b\d{1,3}\s*[/]\s*[MFO]\b",
    "name_prefix": r"\b(?:DR\.?|MR\.?|MRS\.?|MS\.?|SHRI|SMT|S/O|D/O|W/O)\b",
    "accession": r"\b(?:ACC|ACCNO|ACCESSION)[\s:.-]?\w+\b",
}
#: Fixed value: scrubbing knows dates with the day first only.
SCRUB_DATE = r"\b\d{1,2}[-/.]\d{1,2}[-/.]\d{2,4}\b"
SCRUB_PATTERNS = [SCRUB_DATE if name == "date" else p for name, p in PATTERNS.items()]

#: Labels that mark personal data wherever they occur.
DEMOGRAPHIC = """NAME|PATIENT|DATE|DOB|D0B|0B:|BIRTH|MRN|UHID|PID|AGE|SEX|GENDER|MALE|FEMALE|DR.|DOCTOR|PHYSICIAN|HOSPITAL|HOSP|CLINIC|INSTITUT|CONFIDENTIAL|CONFIDCNTTIAC|RESTRICTED|PROPRIETARY|SECRET""".split("|")

#: Terms that are kept.
ALLOWED = """L R LT RT LEFT RIGHT PA AP LAT LL RL LATERAL ERECT SUPINE PRONE DECUBITUS UPRIGHT PORTABLE MOBILE STAT ROUTINE
CHEST ABDOMEN PELVIS SKULL SPINE KVP MAS MA SEC CM MM FOV CXR CX""".split() + ["PA VIEW", "AP VIEW"]
#: Further terms of the token test, of its merging variant, and whole texts.
ALSO_TOKENS = """ANTEROPOSTERIOR POSTEROANTERIOR ANIIEROPOSTERIOR ANIIEROPAOSIIERIORR PROJECTION ANTERIOR POSTERIOR ERECT SUPINE CHEST
PORTABLE L26 R26 L12 R12""".split()
WHOLE = "L26 R26 L1 R1 L2 R2 L3 R3".split()
WHOLE_MERGING = "L26 R26 L1 R1 L2 R2 CXR".split()
#: The vocabulary of the whole-text test.
PURE = """L R LT RT LEFT RIGHT PA AP LAT LL RL LATERAL A P M F O CXR CHEST PORTABLE MOBILE SUPINE ERECT UPRIGHT SEMI-UPRIGHT SEMI UPPER
LOWER MIDDLE LOBE LUL RUL LLL RLL RML CLAVICLE RIB HEART LUNG LUNGS DIAPHRAGM TRACHEA BRONCHUS APEX BASE CARDIAC AORTA PLEURAL ANGLE
COSTOPHRENIC SULCUS MEDIASTINUM HILUM HILAR PARENCHYMA PARENCHYMAL QUADRANT KV KVP MA MAS MS SEC MM CM EXP EXPOSURE TECH TECHNOLOGIST
COLLIMATION FILTER FSD SID SOD MASE GRID NO-GRID NOGRID SANS INSPIRATION EXPIRATION INSP INT EXT MED DECUB DECUBITUS VIEW OF AND TO
WITH FOR ON BY IN THE PORT AP-PORTABLE PA-ERECT AP/PA NORMAL PNEUMOTHORAX EFFUSION INFILTRATE CONSOLIDATION EDEMA CARDIOMEGALY
PNEUMONIA OPACITY OPACITIES AORTIC SIEMENS PHILIPS GE HEALTHCARE MEDICAL SYSTEMS MICRODICOM ANTEROPOSTERIOR POSTEROANTERIOR
ANIIEROPOSTERIOR ANIIEROPAOSIIERIORR PROJECTION ANTERIOR POSTERIOR L26 R26""".split()
#: Side and view marks, spine levels, exposure numbers.
SIDE_MARK = r"^(?:L|R|LT|RT|LA|RA|LP|RP|PA|AP|LL|RL|A|P)\s*\d{0,3}$"
LEVEL = r"^(?:L|R|C|T|S)\d{1,2}$"
LEVEL_OR_LETTER = r"^(?:L|R|C|T|S)\d{0,2}$"
EXPOSURE = r"^\d{1,4}(?:\.\d+)?(?:\s*-\s*\d{1,4}(?:\.\d+)?)?$"
#: Body parts that rule a series out.
OTHER_ANATOMY = (
    r"\b(HAND|FINGER|THUMB|WRIST|FOREARM|ELBOW|HUMERUS|SHOULDER|CLAVICLE|SCAPULA|FOOT|TOE|ANKLE|HEEL|CALCANEUM|TIBIA|FIBULA|KNEE|PATELLA"
    r"|FEMUR|HIP|PELVIS|SPINE|CERVICAL|THORACIC SPINE|LUMBAR|L S|LS|SACRUM|COCCYX|SKULL|NASAL|SINUS|PNS|MANDIBLE|FACE|ORBIT|ABDOMEN|KUB)\b"
)


def has_pattern(text: Column, name: str) -> Column:
    return text.rlike("(?iU)" + PATTERNS[name])


def pattern_reasons(text: Column) -> Column:
    return F.filter(F.array(*[F.when(has_pattern(text, n), F.lit(f"regex:{n}")) for n in PATTERNS]), lambda x: x.isNotNull())


def has_demographic_label(text: Column) -> Column:
    labels = "|".join("\\Q" + x + "\\E" for x in DEMOGRAPHIC)
    return F.upper(text).rlike(r"(?U)" + labels + r"|\bID\b")


def _all_tokens(upper: Column, known: list[str], *patterns: str, least: int = 0) -> Column:
    """Whether each token (at least `least` of them) is known or matches a pattern."""
    words = F.array(*[F.lit(x) for x in dict.fromkeys(known)])
    ok = lambda t: F.array_contains(words, t) | t.rlike("|".join(patterns))
    return bind(F.regexp_extract_all(upper, F.lit("[A-Z0-9]+"), F.lit(0)), lambda tokens: (F.size(tokens) >= least) & F.forall(tokens, ok))


def is_clinical(text: Column) -> Column:
    """Allowed term once stripped of all but letters and digits, side mark, or nothing but allowed tokens (at least one)."""
    plain = lambda u: F.regexp_replace(u, "[^A-Z0-9]", "").isin(ALLOWED + WHOLE)
    return bind(F.upper(trimmed(text)), lambda u: u.rlike(SIDE_MARK) | plain(u) | _all_tokens(u, ALLOWED + ALSO_TOKENS, LEVEL, least=1))


def is_clinical_for_merging(text: Column) -> Column:
    """As is_clinical, but compared as it stands, and true for empty text."""
    known = ALLOWED + ALSO_TOKENS + ["CXR"]
    return bind(F.upper(trimmed(text)), lambda u: (u == "") | u.rlike(SIDE_MARK) | u.isin(ALLOWED + WHOLE_MERGING) | _all_tokens(u, known, LEVEL, least=1))


def is_pure_clinical(text: Column) -> Column:
    """Nothing but known terms, numbers of up to four digits and levels; true without any token."""
    return _all_tokens(F.upper(trimmed(text)), PURE, r"^\d{1,4}$", LEVEL_OR_LETTER)


def keyword_is_id(keyword: Column) -> Column:
    return F.coalesce(~keyword.endswith("UID") & (keyword.endswith("ID") | keyword.endswith("IDs")), F.lit(False))


def tag_category(keyword: Column, vr: Column) -> Column:
    """The kind of personal data a tag holds, by the first rule that fits; null for none."""
    low = F.lower(keyword)
    return (
        F.when(vr == "TM", "time").when(vr == "DA", "date").when((vr == "AS") | (keyword == "PatientAge"), "age")
        .when(keyword == "AccessionNumber", "accession").when(low.contains("weight"), "weight")
        .when(low.contains("description"), "description").when(low.contains("address"), "address")
        .when(keyword_is_id(keyword), "id").when((vr == "PN") | low.contains("name"), "name")
    )


def date_fallback(keyword: Column, vr: Column) -> Column:
    return F.when(vr.isin("DA", "DT"), "mask").when(F.lower(keyword).contains("date"), "suppress")


def chest_reason(has_rows: Column, modality: Column, body: Column, study: Column, series: Column) -> Column:
    """Null for a chest image, else why not, by the first rule that fails."""
    clean = lambda c: F.coalesce(F.trim(F.upper(c)), F.lit(""))
    modality, body, study, series = map(clean, (modality, body, study, series))
    shown = lambda c, none: F.when(c == "", none).otherwise(c)
    return (
        F.when(~has_rows | (modality == "PR"), F.concat(F.lit("not an image object (Modality="), shown(modality, "none"), F.lit(")")))
        .when(body != "CHEST", F.concat(F.lit("BodyPartExamined="), shown(body, "empty")))
        .when((study != "") & ~study.contains("CHEST"), F.concat(F.lit("StudyDescription does not mention CHEST ("), F.substring(study, 1, 60), F.lit(")")))
        .when(series.rlike(OTHER_ANATOMY), F.concat(F.lit("SeriesDescription names other anatomy ("), F.regexp_extract(series, OTHER_ANATOMY, 0), F.lit(")")))
    )


def reason_key(reason: Column) -> Column:
    return F.split(F.split(reason, r" \(").getItem(0), "=").getItem(0)
