"""Documented readmission analyses, as queries over the readmission fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions import count_true, pct

GLOBAL_LABEL = "Global"


def _eligible(readmissions: DataFrame) -> DataFrame:
    return readmissions.filter(F.col("is_eligible_index_stay"))


def readmission_by_age_band(readmissions: DataFrame) -> DataFrame:
    """Eligible stays, readmissions and rate per age band at stay, plus a Global row."""
    band = F.col("age_band_at_stay")
    n = F.count(F.lit(1))
    return (_eligible(readmissions).rollup(band)
            .agg(F.grouping(band).alias("_g"), n.alias("eligible_stays"),
                 count_true("is_readmitted_30d").alias("readmissions_30d"),
                 pct(count_true("is_readmitted_30d"), n, 1).alias("readmission_rate_pct"))
            .select(F.when(F.col("_g") == 1, F.lit(GLOBAL_LABEL)).otherwise(band).alias("age_band"),
                    "eligible_stays", "readmissions_30d", "readmission_rate_pct"))


def readmission_concentration(readmissions: DataFrame) -> DataFrame:
    """How many patients produce all 30-day readmissions, and how many each."""
    per_patient = (_eligible(readmissions).filter(F.col("is_readmitted_30d"))
                   .groupBy("patient_id").agg(F.count(F.lit(1)).alias("n")))
    return per_patient.agg(
        F.count(F.lit(1)).alias("patients_with_readmission"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("readmissions_30d"),
        F.round(F.avg("n"), 1).alias("readmissions_per_patient"))


def median_gap_by_code(readmissions: DataFrame) -> DataFrame:
    """Exact median days from discharge to the next admission, by the next stay's code."""
    return (_eligible(readmissions).filter(F.col("days_to_readmission").isNotNull())
            .groupBy(F.col("readmission_encounter_code").alias("encounter_code"))
            .agg(F.count(F.lit(1)).alias("stays_with_next"),
                 F.median("days_to_readmission").alias("median_days_to_readmission")))


def readmission_code_share(readmissions: DataFrame) -> DataFrame:
    """Share of 30-day readmissions carried by each readmission code.

    Aggregated per code first; only the per-code counts meet for the total.
    """
    per_code = (_eligible(readmissions).filter(F.col("is_readmitted_30d"))
                .groupBy(F.col("readmission_encounter_code").alias("encounter_code"))
                .agg(F.count(F.lit(1)).alias("readmissions_30d")))
    # The total is a window over the per-code counts: one row per distinct
    # code (bounded by the code vocabulary, not by the data), so the single
    # partition is tiny, and the fact is derived once.  A scalar subquery
    # would be planned separately and derive the whole fact a second time.
    total = F.sum("readmissions_30d").over(Window.partitionBy())
    return per_code.withColumn("share_pct", pct(F.col("readmissions_30d"), total, 1))


def readmission_rate_overall(readmissions: DataFrame) -> DataFrame:
    """All-cause against unplanned 30-day readmission rate over all eligible stays."""
    n = F.count(F.lit(1))
    return _eligible(readmissions).agg(
        n.alias("eligible_stays"),
        count_true("is_readmitted_30d").alias("readmissions_30d"),
        count_true("is_readmitted_30d_unplanned").alias("readmissions_30d_unplanned"),
        pct(count_true("is_readmitted_30d"), n).alias("readmission_rate_30d_pct"),
        pct(count_true("is_readmitted_30d_unplanned"), n).alias("readmission_rate_30d_unplanned_pct"))


def encounters_by_age_band(enriched: DataFrame) -> DataFrame:
    """Encounters per age band at encounter (a missing age counts as 80+)."""
    from wardline.functions import age_band
    return (enriched.groupBy(age_band("age_at_encounter").alias("age_band"))
            .agg(F.count(F.lit(1)).alias("encounters"),
                 F.count("age_at_encounter").alias("encounters_with_age")))


def admission_code_classification(encounters: DataFrame, seed: DataFrame) -> DataFrame:
    """Inpatient admission codes in the data with their seed classification.

    Codes absent from the seed default to unplanned (``in_seed`` false).
    """
    from wardline.operators.joins import bounded_broadcast
    codes = (encounters.filter(F.col("encounter_class") == "inpatient")
             .groupBy("encounter_code").agg(F.count(F.lit(1)).alias("inpatient_encounters")))
    s = bounded_broadcast(seed).select("encounter_code", "encounter_label", "is_planned").alias("s")
    return (codes.alias("c").join(s, F.col("c.encounter_code") == F.col("s.encounter_code"), "left")
            .select("c.encounter_code", "s.encounter_label",
                    F.coalesce(F.col("s.is_planned"), F.lit(False)).alias("is_planned"),
                    F.col("s.encounter_code").isNotNull().alias("in_seed"), "c.inpatient_encounters"))
