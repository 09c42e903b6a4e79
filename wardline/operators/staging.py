"""Staging: one typed, renamed row per source row.

Direct identifiers (SSN, names, street address, GPS) are never selected,
so they cannot reach any later layer.  Timestamps are typed as
TIMESTAMP_NTZ (wall-clock, like the warehouse's default TIMESTAMP);
dates as DATE; money and measures as DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TS = "timestamp_ntz"

# Columns that must never appear after staging.
IDENTIFYING_COLUMNS = ("ssn", "drivers", "passport", "prefix", "first", "middle", "last",
                       "suffix", "maiden", "address", "lat", "lon")


def _col(df: DataFrame, name: str):
    """Case-insensitive column lookup (raw headers vary in case)."""
    lower = {c.lower(): c for c in df.columns}
    return F.col(f"`{lower[name.lower()]}`")


def stg_patients(raw: DataFrame) -> DataFrame:
    c = lambda n: _col(raw, n)
    return raw.select(
        c("id").alias("patient_id"),
        c("birthdate").cast("date").alias("birth_date"),
        c("deathdate").cast("date").alias("death_date"),
        c("deathdate").isNotNull().alias("is_deceased"),
        c("gender").alias("gender"),
        c("race").alias("race"),
        c("ethnicity").alias("ethnicity"),
        c("marital").alias("marital_status"),
        c("city").alias("city"),
        c("state").alias("state"),
        c("county").alias("county"),
        c("zip").alias("zip"),
        c("healthcare_expenses").cast("double").alias("healthcare_expenses"),
        c("healthcare_coverage").cast("double").alias("healthcare_coverage"),
    )


def stg_encounters(raw: DataFrame) -> DataFrame:
    c = lambda n: _col(raw, n)
    return raw.select(
        c("id").alias("encounter_id"),
        c("patient").alias("patient_id"),
        c("organization").alias("organization_id"),
        c("provider").alias("provider_id"),
        c("payer").alias("payer_id"),
        c("encounterclass").alias("encounter_class"),
        c("code").alias("encounter_code"),
        c("description").alias("encounter_description"),
        c("start").cast(TS).alias("started_at"),
        c("stop").cast(TS).alias("stopped_at"),
        c("base_encounter_cost").cast("double").alias("base_cost"),
        c("total_claim_cost").cast("double").alias("total_claim_cost"),
        c("payer_coverage").cast("double").alias("payer_coverage"),
        c("reasoncode").alias("reason_code"),
        c("reasondescription").alias("reason_description"),
    )


def stg_conditions(raw: DataFrame) -> DataFrame:
    c = lambda n: _col(raw, n)
    return raw.select(
        c("patient").alias("patient_id"),
        c("encounter").alias("encounter_id"),
        c("code").alias("condition_code"),
        c("description").alias("condition_description"),
        c("start").cast("date").alias("onset_date"),
        c("stop").cast("date").alias("resolved_date"),
        c("stop").isNull().alias("is_active"),
    )


def stg_medications(raw: DataFrame) -> DataFrame:
    c = lambda n: _col(raw, n)
    return raw.select(
        c("patient").alias("patient_id"),
        c("encounter").alias("encounter_id"),
        c("payer").alias("payer_id"),
        c("code").alias("medication_code"),
        c("description").alias("medication_description"),
        c("start").cast(TS).alias("started_at"),
        c("stop").cast(TS).alias("stopped_at"),
        c("base_cost").cast("double").alias("base_cost"),
        c("payer_coverage").cast("double").alias("payer_coverage"),
        c("dispenses").cast("int").alias("dispenses"),
        c("totalcost").cast("double").alias("total_cost"),
        c("reasoncode").alias("reason_code"),
        c("reasondescription").alias("reason_description"),
    )


def stg_organizations(raw: DataFrame) -> DataFrame:
    c = lambda n: _col(raw, n)
    return raw.select(
        c("id").alias("organization_id"),
        c("name").alias("organization_name"),
        c("city").alias("city"),
        c("state").alias("state"),
        c("zip").alias("zip"),
        c("revenue").cast("double").alias("revenue"),
        c("utilization").cast("int").alias("utilization"),
    )


STAGING = {
    "patients": stg_patients,
    "encounters": stg_encounters,
    "conditions": stg_conditions,
    "medications": stg_medications,
    "organizations": stg_organizations,
}
