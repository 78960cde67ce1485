"""Conforming the CSV tables of an external clinical system to the five EMR sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.draws import draw_int
from ..functions.names import split_full_name
from ..operators.keys import rank_within
from ..operators.latest import latest_per_key
from .fixtures import fill_missing

# Visit classes, and the procedure codes used where no mapping exists.
VISIT_TYPES = {
    "ambulatory": "outpatient", "outpatient": "outpatient", "inpatient": "inpatient",
    "emergency": "emergency", "urgentcare": "urgent_care", "wellness": "wellness",
    "office": "outpatient", "virtual": "telehealth",
}
FALLBACK_PROCEDURES = {
    "99213": "Office visit", "99214": "Office visit high", "85025": "CBC", "80053": "CMP",
    "71046": "Chest X-ray", "93000": "ECG", "99395": "Preventive visit",
}


def _capped(df: DataFrame, order: str, limit: int | None) -> DataFrame:
    """All rows, or the first `limit` where a feed size is asked for.

    Rows are in order of the key, then of all other columns, so that the same
    rows are taken each time.
    """
    if limit is None:
        return df
    return df.orderBy(order, *[c for c in df.columns if c != order]).limit(limit)


def patients(external: DataFrame, last_updated_at: str, rules: dict[str, Column] | None = None,
             limit: int | None = None) -> DataFrame:
    """Living patients with the last four digits of their SSN; gaps filled by `rules`."""
    living = _capped(external.filter(F.col("DEATHDATE").isNull()), "Id", limit)
    out = living.select(
        F.col("Id").alias("emr_patient_id"), F.col("FIRST").alias("first_name"),
        F.col("LAST").alias("last_name"), F.col("BIRTHDATE").alias("dob"),
        F.col("GENDER").alias("sex"), F.col("ADDRESS").alias("address_line1"),
        F.col("CITY").alias("city"), F.col("STATE").alias("state"), F.col("ZIP").alias("zip"),
        F.right("SSN", F.lit(4)).alias("ssn_last4"), F.lit("N").alias("deceased_flag"),
        F.lit(last_updated_at).alias("last_updated_at"))
    return fill_missing(out, rules or {})


def providers(external: DataFrame, organizations: DataFrame | None = None,
              rules: dict[str, Column] | None = None, limit: int | None = None) -> DataFrame:
    """Providers with their names split and, where the list exists, their organisation's name."""
    rows = _capped(external, "Id", limit)
    if organizations is None:
        named = rows.withColumn("org_name", F.lit(None).cast("string"))
    else:
        listed = organizations.select(F.col("Id").alias("ORGANIZATION"),
                                      F.col("NAME").alias("org_name"))
        named = rows.join(listed, "ORGANIZATION", "left")
    first, last = split_full_name("NAME")
    out = named.select(
        F.col("Id").alias("emr_provider_id"), first.alias("first_name"), last.alias("last_name"),
        F.col("SPECIALITY").alias("specialty"), "org_name",
        F.col("ADDRESS").alias("address_line1"), F.col("CITY").alias("city"),
        F.col("STATE").alias("state"), F.col("ZIP").alias("zip"))
    return fill_missing(out, rules or {})


def _of_patients(external: DataFrame, known: DataFrame) -> DataFrame:
    ids = known.select(F.col("emr_patient_id").alias("PATIENT")).distinct()
    return external.join(ids, "PATIENT", "left_semi")


def encounters(external: DataFrame, known: DataFrame, rules: dict[str, Column] | None = None,
               limit: int | None = None) -> DataFrame:
    """Completed visits of known patients, classes mapped to visit types."""
    rows = _capped(_of_patients(external, known), "Id", limit)
    kinds = F.create_map(*[F.lit(x) for pair in VISIT_TYPES.items() for x in pair])
    out = rows.select(
        F.col("Id").alias("emr_encounter_id"), F.col("PATIENT").alias("emr_patient_id"),
        F.coalesce(kinds[F.lower("ENCOUNTERCLASS")], F.lit("outpatient")).alias("encounter_type"),
        F.lit("completed").alias("status"), F.col("START").alias("start_time"),
        F.col("STOP").alias("end_time"), F.col("ORGANIZATION").alias("facility_id"),
        F.col("PROVIDER").alias("attending_provider_id"))
    return fill_missing(out, rules or {})


def diagnoses(external: DataFrame, known: DataFrame, limit: int | None = None) -> DataFrame:
    """Conditions of known patients, ranked per visit by onset, then code and text.

    A condition without a visit has no rank.
    """
    rows = _capped(_of_patients(external, known), "ENCOUNTER", limit)
    ranked = rank_within(rows.filter("ENCOUNTER IS NOT NULL"), "ENCOUNTER",
                         ["START", "CODE", "DESCRIPTION"], "diagnosis_rank")
    unplaced = rows.filter("ENCOUNTER IS NULL").withColumn(
        "diagnosis_rank", F.lit(None).cast("int"))
    return ranked.unionByName(unplaced).select(
        F.col("ENCOUNTER").alias("emr_encounter_id"), F.col("CODE").alias("icd10_code"),
        F.col("DESCRIPTION").alias("diagnosis_desc"), "diagnosis_rank")


def procedure_map(crosswalk: DataFrame, line: str) -> DataFrame:
    """Code mapping with one row per code; the last line of a repeated code counts."""
    return latest_per_key(crosswalk.filter("snomed_code IS NOT NULL"), [F.col("snomed_code")],
                          [F.desc(line)]).select("snomed_code", "cpt_code", "cpt_description")


def procedures(external: DataFrame, known: DataFrame, mapping: DataFrame,
               limit: int | None = None) -> DataFrame:
    """Procedures of known patients with billing codes; unmapped codes get a drawn one."""
    rows = _capped(_of_patients(external, known), "ENCOUNTER", limit)
    codes = F.array(*[F.lit(c) for c in FALLBACK_PROCEDURES])
    texts = F.array(*[F.lit(t) for t in FALLBACK_PROCEDURES.values()])
    key = F.concat_ws("|", "ENCOUNTER", "CODE", "DATE")
    slot = draw_int(key, "procedure", 1, len(FALLBACK_PROCEDURES))
    joined = rows.join(mapping.withColumnRenamed("snomed_code", "CODE"), "CODE", "left")
    return joined.select(
        F.col("ENCOUNTER").alias("emr_encounter_id"),
        F.coalesce("cpt_code", F.element_at(codes, slot)).alias("cpt_code"),
        F.when(F.col("cpt_code").isNotNull(), F.col("cpt_description"))
        .otherwise(F.element_at(texts, slot)).alias("procedure_desc"),
        F.col("DATE").alias("performed_time"))
