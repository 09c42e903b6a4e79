"""Anchors of FIXTURES.md §3 at sf0.001."""

from pyspark.sql import functions as F

from wardline.registry import graph

from conftest import SF_SMALL


def test_fixture_anchors(spark):
    g = graph(spark, SF_SMALL)
    e = g.int_encounters_enriched
    r = g.fct_readmissions
    assert g.stg_patients.count() == 150
    assert g.stg_encounters.count() == 1500
    assert e.count() == 1468
    assert e.filter(F.col("has_invalid_timestamps")).count() == 35
    assert e.filter(F.col("duration_minutes").isNull()).count() == 67
    ages = e.agg(F.min("age_at_encounter"), F.max("age_at_encounter")).first()
    assert (ages[0], ages[1]) == (2, 91)
    assert g.stg_encounters.join(g.stg_patients, "patient_id", "left_anti").count() == 32
    assert g.stg_conditions.join(g.stg_patients, "patient_id", "left_anti").count() == 94
    assert g.stg_patients.join(g.stg_conditions, "patient_id", "left_anti").count() == 15
    assert g.stg_conditions.count() == 6000
    assert g.stg_medications.count() == 6000
    assert g.dim_organizations.count() == 10
    assert g.mart_organization_kpis.filter(F.col("total_encounters").isNull()).count() == 1
    assert g.dim_patients.filter(F.col("is_polypathologic")).count() == 133
    assert r.count() == 577
    assert r.filter(F.col("is_eligible_index_stay")).count() == 529
    assert r.filter(F.col("is_readmitted_30d")).count() == 28
    assert r.filter(F.col("is_readmitted_30d_unplanned")).count() == 15
    assert r.filter(F.col("is_planned_readmission")).count() == 187
    assert r.filter(F.col("overlaps_next_stay")).count() == 12
    assert r.filter(F.col("has_invalid_timestamps")).count() == 17
    assert r.filter(F.col("died_during_index_stay")).count() == 17
    hu = g.mart_high_utilizers
    assert hu.count() == 145 and hu.filter(F.col("is_high_utilizer")).count() == 0
    assert g.fct_encounters.filter(F.col("encounter_code").isNull()).count() == 28
    assert g.fct_encounters.filter(F.col("started_at").isNull()).count() == 17
