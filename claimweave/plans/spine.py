"""Patient records of all systems in one shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.keys import row_positions

SPINE_COLUMNS = (
    "source_system", "source_patient_key", "mrn", "ssn_last4", "first_name", "last_name", "dob",
    "phone", "email", "address_line1", "city", "state", "zip", "emr_patient_id_link",
)

# Spine column -> source column, where the names differ; columns absent from a
# system are NULL.
_MAPS = {
    "emr": {"source_patient_key": "emr_patient_id"},
    "rcm": {"source_patient_key": "rcm_account_id", "first_name": "patient_first_name",
            "last_name": "patient_last_name", "emr_patient_id_link": "emr_patient_id"},
    "referral": {"source_patient_key": "referral_order_id", "first_name": "patient_first_name",
                 "last_name": "patient_last_name"},
}


def _shape(df: DataFrame, system: str) -> DataFrame:
    names = _MAPS[system]
    out = [F.lit(system).alias("source_system")]
    for column in SPINE_COLUMNS[1:]:
        source = names.get(column, column)
        value = F.col(source) if source in df.columns else F.lit(None).cast("string")
        out.append(value.alias(column))
    return df.select(*out)


def spine(emr: DataFrame, rcm: DataFrame, referral: DataFrame) -> DataFrame:
    parts = [_shape(emr, "emr"), _shape(rcm, "rcm"), _shape(referral, "referral")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def numbered(records: DataFrame) -> DataFrame:
    """Add `node` (system::key) and `nid`, its position in node order.

    Comparing `nid` is comparing node names, so everything downstream joins and
    takes minima on an 8-byte number. The result is stored.
    """
    named = records.withColumn("node", F.concat_ws("::", "source_system", "source_patient_key"))
    return row_positions(named, [F.col("node").asc_nulls_last()], "nid")
