"""The declared checks: 113 on cleaned tables, 27 on linkage, 34 on the star schema."""

from __future__ import annotations

from ..operators.quality import Check
from ..sources import layout as L
from .rules import RULES

# Columns that may not be NULL, besides the lineage columns of every cleaned table.
_REQUIRED = {
    "emr_patient": "emr_patient_id mrn first_name last_name dob",
    "emr_encounter": "emr_encounter_id emr_patient_id start_time",
    "emr_diagnosis": "emr_encounter_id icd10_code",
    "emr_procedure": "emr_encounter_id cpt_code",
    "emr_provider": "emr_provider_id",
    "rcm_patient_account": "rcm_account_id patient_external_id",
    "rcm_claim_header": "claim_id rcm_account_id total_charge_amount",
    "rcm_claim_line": "claim_id line_num cpt_code charge_amount",
    "rcm_remittance_835": "remit_id payer_id payment_date total_payment_amount",
    "rcm_ar_balance_snapshot": "snapshot_date claim_id rcm_account_id",
    "referral_order": "referral_order_id patient_first_name patient_last_name dob",
    "referral_order_status_history": "referral_order_id status status_time",
    "referral_document_reference": "referral_order_id doc_type doc_uri",
}
_LISTED = {
    "emr_patient": {"sex": L.SEX},
    "emr_encounter": {"encounter_type": L.ENCOUNTER_TYPE, "status": L.ENCOUNTER_STATUS},
    "rcm_claim_header": {"claim_type": L.CLAIM_TYPE, "claim_status": L.CLAIM_STATUS},
    "rcm_ar_balance_snapshot": {"aging_bucket": L.AGING_BUCKET},
    "referral_order": {"priority": L.PRIORITY, "order_status": L.ORDER_STATUS,
                       "counterparty_org_type": L.COUNTERPARTY_TYPE},
    "referral_document_reference": {"doc_type": L.DOC_TYPE},
}
_PARENTS = {
    "emr_encounter": ("emr_patient_id", "emr_patient"),
    "emr_diagnosis": ("emr_encounter_id", "emr_encounter"),
    "emr_procedure": ("emr_encounter_id", "emr_encounter"),
    "rcm_claim_header": ("rcm_account_id", "rcm_patient_account"),
    "rcm_claim_line": ("claim_id", "rcm_claim_header"),
    "rcm_ar_balance_snapshot": ("claim_id", "rcm_claim_header"),
    "referral_order_status_history": ("referral_order_id", "referral_order"),
    "referral_document_reference": ("referral_order_id", "referral_order"),
}


def _not_null(table: str, columns: str) -> list[Check]:
    return [Check(table, "not_null", (c,)) for c in columns.split()]


def _clean_checks() -> list[Check]:
    out = []
    for source in L.SOURCES.values():
        name = source.name
        kind = "unique" if len(source.key) == 1 else "unique_combination"
        out.append(Check(name, kind, source.key))
        out += _not_null(name, _REQUIRED[name] + " _ingested_at _source_system _row_hash")
        out += [Check(name, "accepted_values", (c,), v)
                for c, v in _LISTED.get(name, {}).items()]
        if name in _PARENTS:
            key, parent = _PARENTS[name]
            out.append(Check(name, "relationship", (key,), (parent, key)))
    out += [
        Check("emr_patient", "matches", ("phone",), ("^[0-9]{10,11}$",), "warn"),
        Check("emr_patient", "length", ("state",), (2,)),
        Check("emr_patient", "matches", ("zip",), ("^[0-9]{5}$",)),
        Check("emr_provider", "matches", ("npi",), ("^[0-9]{10}$",)),
    ]
    return out


def _linkage_checks() -> list[Check]:
    patient = ("dim_patient", "patient_id")
    return [
        *_not_null("patient_spine", "source_patient_key source_system"),
        Check("patient_spine", "accepted_values", ("source_system",), L.SYSTEMS),
        *_not_null("deterministic_match", "source_key_a source_key_b confidence match_method"),
        Check("deterministic_match", "accepted_values", ("match_method",),
              tuple(r.name for r in RULES)),
        *_not_null("probabilistic_match", "confidence"),
        Check("probabilistic_match", "between", ("confidence",), (0.70, 1.0)),
        Check("final_match", "unique_combination", ("source_system", "source_patient_key")),
        *_not_null("final_match", "patient_id source_system source_patient_key match_method"),
        Check("final_match", "accepted_values", ("source_system",), L.SYSTEMS),
        Check("dim_patient", "unique", ("patient_id",)),
        *_not_null("dim_patient", "patient_id best_first_name best_last_name best_dob"),
        Check("patient_source_xref", "unique_combination",
              ("patient_id", "source_system", "source_patient_key")),
        *_not_null("patient_source_xref",
                   "patient_id source_system source_patient_key match_confidence"),
        Check("patient_source_xref", "relationship", ("patient_id",), patient),
    ]


def _star_checks() -> list[Check]:
    patient = ("dim_patient", "patient_id")

    def key(table, column):
        return [Check(table, "unique", (column,)), *_not_null(table, column)]

    return [
        *key("dim_date", "date_key"), *key("dim_provider", "provider_key"),
        *key("dim_facility", "facility_key"), *key("dim_facility", "source_facility_id"),
        *key("dim_counterparty_org", "counterparty_org_key"),
        Check("dim_counterparty_org", "accepted_values", ("counterparty_org_type",),
              L.COUNTERPARTY_TYPE),
        *key("dim_payer", "payer_key"), *key("dim_payer", "payer_name"),
        Check("bridge_patient_counterparty", "unique_combination",
              ("patient_id", "counterparty_org_key")),
        *_not_null("bridge_patient_counterparty", "patient_id counterparty_org_key"),
        Check("bridge_patient_counterparty", "relationship", ("patient_id",), patient),
        Check("bridge_patient_counterparty", "relationship", ("counterparty_org_key",),
              ("dim_counterparty_org", "counterparty_org_key")),
        Check("fact_receivable", "unique_combination", ("claim_id", "snapshot_date")),
        *_not_null("fact_receivable", "claim_id snapshot_date total_ar_balance"),
        Check("fact_patient_balance", "unique_combination", ("patient_id", "snapshot_date")),
        *_not_null("fact_patient_balance", "patient_id snapshot_date total_outstanding"),
        Check("fact_patient_balance", "relationship", ("patient_id",), patient),
        Check("fact_claim_line", "unique_combination", ("claim_id", "line_num")),
        *_not_null("fact_claim_line", "claim_id line_num charge_amount is_denied"),
    ]


CLEAN_CHECKS = _clean_checks()
LINKAGE_CHECKS = _linkage_checks()
STAR_CHECKS = _star_checks()
