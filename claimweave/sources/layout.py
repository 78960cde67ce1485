"""Source tables: columns, cleaning rules, dedup keys and value lists.

A field is (name, rule, *arguments). All source columns are text when they
arrive; the rule says what the cleaned layer makes of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The codes each list-checked column may hold.
SEX = ("M", "F", "O", "U")
ENCOUNTER_TYPE = ("outpatient", "inpatient", "ed")
ENCOUNTER_STATUS = ("planned", "in-progress", "completed", "cancelled")
CLAIM_TYPE = ("institutional", "professional")
CLAIM_STATUS = ("submitted", "accepted", "denied", "paid", "void")
AGING_BUCKET = ("0-30", "31-60", "61-90", "90+")
OVERDUE_BUCKETS = ("61-90", "90+")
PRIORITY = ("routine", "urgent")
ORDER_STATUS = ("received", "scheduled", "completed", "cancelled")
COUNTERPARTY_TYPE = ("law_firm", "pi_firm", "clinic", "employer")
DOC_TYPE = ("referral_form", "imaging", "insurance_card")
SYSTEMS = ("emr", "rcm", "referral")

LINEAGE = ("_ingested_at", "_source_system", "_source_file", "_row_hash")

RULE_TYPES = {
    "text": T.StringType(), "upper": T.StringType(), "lower": T.StringType(),
    "title": T.StringType(), "digits": T.StringType(), "prefix": T.StringType(),
    "npi": T.StringType(), "one_of": T.StringType(), "one_of_exact": T.StringType(),
    "one_of_or": T.StringType(), "date": T.DateType(), "timestamp": T.TimestampNTZType(),
    "int": T.IntegerType(), "bool": T.BooleanType(),
}


@dataclass(frozen=True)
class Source:
    name: str
    system: str
    key: tuple[str, ...]
    fields: tuple[tuple, ...]
    multi_line: bool = False  # whether quoted values may hold line breaks, so files are not split

    @property
    def columns(self) -> list[str]:
        return [f[0] for f in self.fields]

    @property
    def file(self) -> str:
        return f"{self.name}.csv"

    def rule(self, column: str) -> tuple:
        return next(f[1:] for f in self.fields if f[0] == column)

    def landed_schema(self) -> T.StructType:
        fields = [T.StructField(c, T.StringType()) for c in self.columns]
        fields.append(T.StructField("_ingested_at", T.TimestampNTZType()))
        fields += [T.StructField(c, T.StringType()) for c in LINEAGE[1:]]
        return T.StructType(fields)

    def clean_schema(self) -> T.StructType:
        fields = []
        for name, rule, *args in self.fields:
            kind = T.DecimalType(*args) if rule == "decimal" else RULE_TYPES[rule]
            fields.append(T.StructField(name, kind))
        fields.append(T.StructField("_ingested_at", T.TimestampNTZType()))
        fields += [T.StructField(c, T.StringType()) for c in LINEAGE[1:]]
        fields.append(T.StructField("_silver_loaded_at", T.TimestampType()))
        return T.StructType(fields)


def _place(*, zip_rule=("prefix", 5)):
    return (
        ("address_line1", "upper"), ("city", "upper"), ("state", "upper"), ("zip", *zip_rule),
    )


MONEY = ("decimal", 12, 2)

SOURCES: dict[str, Source] = {s.name: s for s in (
    Source("emr_patient", "emr", ("emr_patient_id",), (
        ("emr_patient_id", "text"), ("mrn", "upper"), ("first_name", "title"),
        ("last_name", "title"), ("dob", "date"), ("sex", "one_of_or", SEX, "U"),
        ("phone", "digits"), ("email", "lower"), *_place(), ("ssn_last4", "text"),
        ("deceased_flag", "bool"), ("last_updated_at", "timestamp"),
    )),
    Source("emr_encounter", "emr", ("emr_encounter_id",), (
        ("emr_encounter_id", "text"), ("emr_patient_id", "text"),
        ("encounter_type", "one_of", ENCOUNTER_TYPE), ("status", "one_of", ENCOUNTER_STATUS),
        ("start_time", "timestamp"), ("end_time", "timestamp"), ("facility_id", "text"),
        ("attending_provider_id", "text"), ("chief_complaint", "text"),
    )),
    Source("emr_diagnosis", "emr", ("emr_encounter_id", "icd10_code"), (
        ("emr_encounter_id", "text"), ("icd10_code", "upper"), ("diagnosis_desc", "text"),
        ("diagnosis_rank", "int"),
    )),
    Source("emr_procedure", "emr", ("emr_encounter_id", "cpt_code"), (
        ("emr_encounter_id", "text"), ("cpt_code", "text"), ("procedure_desc", "text"),
        ("performed_time", "timestamp"),
    )),
    Source("emr_provider", "emr", ("emr_provider_id",), (
        ("emr_provider_id", "text"), ("npi", "npi"), ("first_name", "title"),
        ("last_name", "title"), ("specialty", "text"), ("org_name", "upper"),
        ("phone", "digits"), *_place(),
    )),
    Source("rcm_patient_account", "rcm", ("rcm_account_id",), (
        ("rcm_account_id", "text"), ("emr_patient_id", "text"), ("patient_external_id", "text"),
        ("guarantor_name", "upper"), ("patient_first_name", "title"),
        ("patient_last_name", "title"), ("dob", "date"), ("phone", "digits"), *_place(),
    )),
    Source("rcm_claim_header", "rcm", ("claim_id",), (
        ("claim_id", "text"), ("rcm_account_id", "text"), ("facility_id", "text"),
        ("billing_provider_npi", "npi"), ("rendering_provider_npi", "npi"),
        ("payer_id", "text"), ("payer_name", "text"), ("claim_type", "one_of", CLAIM_TYPE),
        ("total_charge_amount", *MONEY), ("claim_status", "one_of", CLAIM_STATUS),
        ("submitted_date", "date"), ("service_from_date", "date"), ("service_to_date", "date"),
    )),
    Source("rcm_claim_line", "rcm", ("claim_id", "line_num"), (
        ("claim_id", "text"), ("line_num", "int"), ("cpt_code", "text"),
        ("units", "decimal", 10, 2), ("charge_amount", *MONEY), ("allowed_amount", *MONEY),
        ("paid_amount", *MONEY), ("denial_code", "text"),
    )),
    Source("rcm_remittance_835", "rcm", ("remit_id",), (
        ("remit_id", "text"), ("payer_id", "text"), ("payment_date", "date"),
        ("trace_number", "text"), ("total_payment_amount", *MONEY),
        ("raw_835_document_ref", "text"),
    )),
    Source("rcm_ar_balance_snapshot", "rcm", ("snapshot_date", "claim_id"), (
        ("snapshot_date", "date"), ("claim_id", "text"), ("rcm_account_id", "text"),
        ("payer_responsibility_balance", *MONEY), ("patient_responsibility_balance", *MONEY),
        ("aging_bucket", "one_of_exact", AGING_BUCKET),
    )),
    Source("referral_order", "referral", ("referral_order_id",), (
        ("referral_order_id", "text"), ("referral_source_system", "text"),
        ("referral_created_at", "timestamp"), ("patient_first_name", "title"),
        ("patient_last_name", "title"), ("dob", "date"), ("phone", "digits"),
        ("email", "lower"), *_place(), ("referring_provider_name", "text"),
        ("referring_provider_npi", "npi"), ("receiving_facility_id", "text"),
        ("primary_diagnosis_icd10", "upper"), ("requested_service_cpt", "text"),
        ("priority", "one_of", PRIORITY), ("order_status", "one_of", ORDER_STATUS),
        ("counterparty_org_name", "text"),
        ("counterparty_org_type", "one_of", COUNTERPARTY_TYPE), ("case_reference_id", "text"),
    )),
    Source("referral_order_status_history", "referral",
           ("referral_order_id", "status", "status_time"), (
        ("referral_order_id", "text"), ("status", "lower"), ("status_time", "timestamp"),
        ("changed_by", "text"),
    )),
    Source("referral_document_reference", "referral",
           ("referral_order_id", "doc_type", "doc_uri"), (
        ("referral_order_id", "text"), ("doc_type", "one_of", DOC_TYPE), ("doc_uri", "text"),
        ("uploaded_at", "timestamp"),
    )),
)}
