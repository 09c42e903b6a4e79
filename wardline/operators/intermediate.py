"""Intermediate models: enriched encounters, inpatient stays, condition summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions import count_true, minutes_between, years_between
from wardline.operators.sequence import sequence_within


def int_encounters_enriched(encounters: DataFrame, patients: DataFrame) -> DataFrame:
    """Encounters with cost, duration, validity and patient attributes.

    Inner join: encounters whose patient is unknown are dropped.  The
    duration is NULL when either stamp is missing or the stop precedes the
    start; ``has_invalid_timestamps`` stays NULL when a stamp is missing.
    """
    e, p = encounters.alias("e"), patients.alias("p")
    start, stop = F.col("e.started_at"), F.col("e.stopped_at")
    return e.join(p, F.col("e.patient_id") == F.col("p.patient_id"), "inner").select(
        "e.encounter_id", "e.patient_id", "e.organization_id", "e.provider_id", "e.payer_id",
        "e.encounter_class", "e.encounter_code", "e.encounter_description",
        "e.started_at", "e.stopped_at", "e.base_cost", "e.total_claim_cost", "e.payer_coverage",
        (F.col("e.total_claim_cost") - F.col("e.payer_coverage")).alias("patient_out_of_pocket"),
        "e.reason_code", "e.reason_description",
        F.when(stop >= start, minutes_between(start, stop)).alias("duration_minutes"),
        (stop < start).alias("has_invalid_timestamps"),
        years_between(F.col("p.birth_date"), F.to_date(start)).alias("age_at_encounter"),
        "p.gender", "p.race", "p.ethnicity",
        F.col("p.state").alias("patient_state"),
    )


def stay_order():
    """Admission first (missing admission last), then encounter id."""
    return (F.col("started_at").asc_nulls_last(), F.col("encounter_id").asc())


def int_inpatient_stays(enriched: DataFrame) -> DataFrame:
    """Inpatient encounters with their sequence number and the next stay.

    Stays are ordered by admission (missing admission last) and then by
    encounter id, which makes ties deterministic.  The
    rows are dealt by ranges of (patient, admission, encounter id).
    """
    stays = enriched.filter(F.col("encounter_class") == "inpatient").select(
        "encounter_id", "patient_id", "organization_id", "encounter_code",
        "started_at", "stopped_at", "duration_minutes", "has_invalid_timestamps",
        "age_at_encounter", "total_claim_cost")
    seq = sequence_within(stays, "patient_id", stay_order(), "stay_sequence",
                          {"next_stay_id": "encounter_id", "next_admitted_at": "started_at",
                           "next_encounter_code": "encounter_code"})
    return seq.select(
        "encounter_id", "patient_id", "organization_id", "encounter_code",
        F.col("started_at").alias("admitted_at"), F.col("stopped_at").alias("discharged_at"),
        "duration_minutes", "has_invalid_timestamps", "age_at_encounter", "total_claim_cost",
        "stay_sequence", "next_stay_id", "next_admitted_at", "next_encounter_code")


def int_patient_condition_summary(conditions: DataFrame) -> DataFrame:
    """Condition burden per patient (patients with at least one condition)."""
    return conditions.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("total_conditions"),
        F.countDistinct("condition_code").alias("distinct_conditions"),
        count_true("is_active").alias("active_conditions"),
        F.min("onset_date").alias("first_condition_date"),
        F.max("onset_date").alias("latest_condition_date"),
    )
