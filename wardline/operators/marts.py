"""Marts: dimensions, facts and indicator tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions import age_band, count_true, days_between, money_avg, money_sum, pct, years_between
from wardline.operators.joins import bounded_broadcast

HIGH_UTILIZER_STAYS = 10        # stays per patient that flag a high utilizer
POLYPATHOLOGY_ACTIVE = 3        # active conditions that flag polypathology
READMISSION_WINDOW_DAYS = 30


def _as_of_col(as_of):
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, (dt.date, str)):
        return F.lit(str(as_of)).cast("date")
    return as_of


def dim_patients(patients: DataFrame, condition_summary: DataFrame, as_of=None) -> DataFrame:
    """One row per patient with age (at ``as_of`` or at death) and condition burden.

    ``as_of`` defaults to today, which makes the table change daily; pass a
    date for reproducible output.
    """
    p, c = patients.alias("p"), condition_summary.alias("c")
    age = years_between(F.col("p.birth_date"), F.coalesce(F.col("p.death_date"), _as_of_col(as_of)))
    active = F.coalesce(F.col("c.active_conditions"), F.lit(0).cast("long"))
    return (p.join(c, F.col("p.patient_id") == F.col("c.patient_id"), "left")
            .select("p.patient_id", "p.gender", "p.race", "p.ethnicity", "p.marital_status",
                    "p.birth_date", "p.death_date", "p.is_deceased", "p.city", "p.state", "p.county",
                    age.alias("age_years"), age_band(age).alias("age_band"),
                    "p.healthcare_expenses", "p.healthcare_coverage",
                    F.coalesce(F.col("c.total_conditions"), F.lit(0).cast("long")).alias("total_conditions"),
                    F.coalesce(F.col("c.distinct_conditions"), F.lit(0).cast("long")).alias("distinct_conditions"),
                    active.alias("active_conditions"),
                    (active >= POLYPATHOLOGY_ACTIVE).alias("is_polypathologic")))


def dim_organizations(organizations: DataFrame) -> DataFrame:
    return organizations.select("organization_id", "organization_name", "city", "state", "zip",
                                "revenue", "utilization")


def fct_encounters(enriched: DataFrame) -> DataFrame:
    """Encounter fact with calendar parts and an emergency indicator."""
    start = F.col("started_at")
    return enriched.select(
        "encounter_id", "patient_id", "organization_id", "provider_id", "payer_id",
        F.to_date(start).alias("encounter_date"), F.year(start).alias("encounter_year"),
        F.month(start).alias("encounter_month"), "started_at", "stopped_at",
        "encounter_class", "encounter_code", "encounter_description", "reason_code", "reason_description",
        "age_at_encounter", "duration_minutes", "has_invalid_timestamps",
        "base_cost", "total_claim_cost", "payer_coverage", "patient_out_of_pocket",
        F.when(F.col("encounter_class") == "emergency", 1).otherwise(0).alias("is_emergency"),
    )


def fct_readmissions(stays: DataFrame, patients: DataFrame, planned: DataFrame) -> DataFrame:
    """One row per inpatient stay with its 30-day readmission flags.

    The index stay leaves the denominator when the patient died during it,
    its stamps are inconsistent, it overlaps the next stay, or it has no
    discharge.  Planned readmissions (by the *next* stay's code, looked up
    in the seed; unknown codes count as unplanned) leave only the
    numerator of the unplanned rate.
    """
    s = stays.alias("s")
    p = patients.select("patient_id", "death_date", "gender", "state").alias("p")
    # The lookup is a small classification list: broadcast it (size verified)
    # rather than shuffling every stay on a key with a handful of values.
    pc = bounded_broadcast(planned).select("encounter_code", "is_planned").alias("pc")
    admitted, discharged, nxt = F.col("s.admitted_at"), F.col("s.discharged_at"), F.col("s.next_admitted_at")
    days = F.when(nxt >= discharged, days_between(discharged, nxt))
    joined = (s.join(p, F.col("s.patient_id") == F.col("p.patient_id"), "inner")
              .join(pc, F.col("s.next_encounter_code") == F.col("pc.encounter_code"), "left")
              .select(
                  F.col("s.encounter_id").alias("index_stay_id"), "s.patient_id", "s.organization_id",
                  "s.stay_sequence",
                  F.to_date(admitted).alias("admitted_date"), F.to_date(discharged).alias("discharged_date"),
                  "s.age_at_encounter", age_band(F.col("s.age_at_encounter")).alias("age_band_at_stay"),
                  "s.total_claim_cost",
                  F.col("s.next_stay_id").alias("readmission_stay_id"),
                  F.to_date(nxt).alias("readmitted_date"),
                  F.col("s.next_encounter_code").alias("readmission_encounter_code"),
                  F.coalesce(F.col("pc.is_planned"), F.lit(False)).alias("is_planned_readmission"),
                  F.coalesce(nxt < discharged, F.lit(False)).alias("overlaps_next_stay"),
                  days.alias("days_to_readmission"),
                  "p.gender", "p.state", "p.death_date",
                  F.coalesce(F.col("p.death_date") <= F.to_date(discharged), F.lit(False))
                   .alias("died_during_index_stay"),
                  "s.has_invalid_timestamps"))
    excluded = (F.col("died_during_index_stay") | F.col("has_invalid_timestamps") | F.col("overlaps_next_stay")
                | F.col("discharged_date").isNull())
    counted = joined.withColumn("is_eligible_index_stay", ~excluded)
    # a gap needs a discharge, so a readmission's index stay has one
    readmitted = F.coalesce(F.col("is_eligible_index_stay") & F.col("days_to_readmission")
                            .between(0, READMISSION_WINDOW_DAYS), F.lit(False))
    return counted.withColumns({"is_readmitted_30d": readmitted,
                                "is_readmitted_30d_unplanned": readmitted & ~F.col("is_planned_readmission")})


def organization_readmission_stats(readmissions: DataFrame) -> DataFrame:
    """Readmission indicators per organization over eligible index stays."""
    n = F.count(F.lit(1))
    return (readmissions.filter(F.col("is_eligible_index_stay"))
            .groupBy("organization_id").agg(
                n.alias("eligible_stays"),
                count_true("is_readmitted_30d").alias("readmissions_30d"),
                count_true("is_readmitted_30d_unplanned").alias("readmissions_30d_unplanned"),
                pct(count_true("is_readmitted_30d"), n).alias("readmission_rate_30d_pct"),
                pct(count_true("is_readmitted_30d_unplanned"), n).alias("readmission_rate_30d_unplanned_pct"),
                F.round(F.avg("days_to_readmission"), 1).alias("avg_days_to_readmission"),
                money_avg("total_claim_cost").alias("avg_stay_cost")))


ACTIVITY_COLUMNS = ("total_encounters", "distinct_patients", "emergency_encounters", "emergency_share_pct",
                    "avg_duration_minutes", "total_claim_cost", "total_out_of_pocket")


def organization_activity_stats(encounters: DataFrame) -> DataFrame:
    """Activity per organization: volume, patients, emergencies, duration, money.

    Works on the encounter fact or on enriched encounters (the emergency
    indicator is derived from the class when absent).
    """
    emergency = (F.col("is_emergency") if "is_emergency" in encounters.columns
                 else F.when(F.col("encounter_class") == "emergency", 1).otherwise(0))
    n = F.count(F.lit(1))
    return encounters.groupBy("organization_id").agg(
        n.alias("total_encounters"),
        F.countDistinct("patient_id").alias("distinct_patients"),
        F.sum(emergency).cast("long").alias("emergency_encounters"),
        pct(F.sum(emergency), n).alias("emergency_share_pct"),
        F.round(F.avg("duration_minutes"), 1).alias("avg_duration_minutes"),
        money_sum("total_claim_cost").alias("total_claim_cost"),
        money_sum("patient_out_of_pocket").alias("total_out_of_pocket"))


def mart_organization_kpis(readmissions: DataFrame, encounters: DataFrame | None,
                           organizations: DataFrame, activity: DataFrame | None = None) -> DataFrame:
    """Organization indicators; organizations without activity are kept.

    Activity columns stay NULL without encounters; readmission counts
    become 0 and rates stay NULL without eligible stays.  ``activity`` may
    be given already aggregated (``organization_activity_stats``).
    """
    o = organizations.alias("o")
    a = (activity if activity is not None else organization_activity_stats(encounters)).alias("a")
    r = organization_readmission_stats(readmissions).alias("r")
    zero = F.lit(0).cast("long")
    return (o.join(a, F.col("o.organization_id") == F.col("a.organization_id"), "left")
            .join(r, F.col("o.organization_id") == F.col("r.organization_id"), "left")
            .select("o.organization_id", "o.organization_name", "o.city", "o.state",
                    *[f"a.{c}" for c in ACTIVITY_COLUMNS],
                    F.coalesce(F.col("r.eligible_stays"), zero).alias("eligible_inpatient_stays"),
                    F.coalesce(F.col("r.readmissions_30d"), zero).alias("readmissions_30d"),
                    F.coalesce(F.col("r.readmissions_30d_unplanned"), zero).alias("readmissions_30d_unplanned"),
                    "r.readmission_rate_30d_pct", "r.readmission_rate_30d_unplanned_pct",
                    "r.avg_days_to_readmission", "r.avg_stay_cost"))


def patient_stay_stats(readmissions: DataFrame) -> DataFrame:
    """Per-patient stay statistics over eligible index stays (exact median)."""
    return (readmissions.filter(F.col("is_eligible_index_stay"))
            .groupBy("patient_id").agg(
                F.count(F.lit(1)).alias("inpatient_stays"),
                count_true("is_readmitted_30d").alias("readmissions_30d"),
                F.round(F.avg("days_to_readmission"), 1).alias("avg_days_between_stays"),
                F.median("days_to_readmission").alias("median_days_between_stays"),
                money_sum("total_claim_cost").alias("total_inpatient_cost"),
                F.min("admitted_date").alias("first_admission"),
                F.max("discharged_date").alias("last_discharge")))


def mart_high_utilizers(readmissions: DataFrame, patients: DataFrame) -> DataFrame:
    """Hospital-use profile per patient with at least one eligible stay."""
    pp = patient_stay_stats(readmissions).alias("pp")
    p = patients.alias("p")
    return (pp.join(p, F.col("pp.patient_id") == F.col("p.patient_id"), "inner")
            .select("pp.patient_id", "p.gender", "p.age_band", "p.state", "p.is_deceased",
                    "p.total_conditions", "p.active_conditions", "p.is_polypathologic",
                    "pp.inpatient_stays", "pp.readmissions_30d", "pp.avg_days_between_stays",
                    "pp.median_days_between_stays", "pp.total_inpatient_cost",
                    "pp.first_admission", "pp.last_discharge",
                    (F.col("pp.inpatient_stays") >= HIGH_UTILIZER_STAYS).alias("is_high_utilizer"),
                    pct(F.col("pp.readmissions_30d"), F.col("pp.inpatient_stays"))
                    .alias("personal_readmission_rate_pct")))


def mart_organization_kpis_rt(enriched: DataFrame, organizations: DataFrame,
                              refreshed_at=None) -> DataFrame:
    """Activity-only organization mart recomputed from enriched encounters."""
    o = organizations.alias("o")
    a = organization_activity_stats(enriched).alias("a")
    return (o.join(a, F.col("o.organization_id") == F.col("a.organization_id"), "left")
            .select("o.organization_id", "o.organization_name", "o.city", "o.state",
                    *[f"a.{c}" for c in ACTIVITY_COLUMNS],
                    (refreshed_at if refreshed_at is not None else F.current_timestamp())
                    .alias("_dt_refreshed_at")))
