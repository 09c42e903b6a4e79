"""Edge rows of the readmission model (FIXTURES §4)."""


import pytest

from wardline.plans.graph import ModelGraph

from helpers import encounter, patient, raw_tables


@pytest.fixture(scope="module")
def g(spark):
    pats = [patient("p1"), patient("p2", death="2020-03-10"), patient("p3", birth="2021-01-01"),
            patient("p4", birth="2019-12-31"), patient("p5"), patient("p6")]
    encs = [
        # p1: gaps of exactly 0, 30 and 31 days; the 0-day one starts at the discharge instant
        encounter("e11", "p1", "2020-01-01 08:00", "2020-01-05 10:00"),
        encounter("e12", "p1", "2020-01-05 10:00", "2020-01-06 09:00"),
        encounter("e13", "p1", "2020-02-05 12:00", "2020-02-06 09:00"),
        encounter("e14", "p1", "2020-03-08 01:00", "2020-03-09 09:00", code="410410006"),
        # p2: died on the discharge day of the first stay; second stay planned code within 30 days
        encounter("e21", "p2", "2020-03-01 08:00", "2020-03-10 23:00"),
        encounter("e22", "p2", "2020-03-11 01:00", "2020-03-12 09:00"),
        # p3: born after the encounter year -> negative age
        encounter("e31", "p3", "2020-05-01 08:00", "2020-05-02 08:00", cls="emergency", org="o2"),
        # p4: born 2019-12-31, seen 2020-01-01 -> age 1; START NULL with STOP set
        encounter("e41", "p4", "2020-01-01 08:00", "2020-01-01 08:00", cls="ambulatory"),
        encounter("e42", "p4", None, "2020-02-01 08:00"),
        # p5: STOP NULL, then an overlapping next stay
        encounter("e51", "p5", "2020-06-01 08:00", None),
        encounter("e52", "p5", "2020-07-01 08:00", "2020-07-10 08:00"),
        encounter("e53", "p5", "2020-07-05 08:00", "2020-07-06 08:00", code="99999999"),
        # p6: discharge 23:00, next admission 01:00 next day (1 day); next is planned
        encounter("e61", "p6", "2020-08-01 08:00", "2020-08-01 23:00"),
        encounter("e62", "p6", "2020-08-02 01:00", "2020-08-03 08:00", code="86013001"),
        # orphan encounter (unknown patient)
        encounter("e99", "px", "2020-01-01 08:00", "2020-01-02 08:00"),
    ]
    return ModelGraph(spark, raw_tables(spark, pats, encs), as_of="2024-01-01")


def _by_id(df, key):
    return {r[key]: r for r in df.collect()}


def test_enriched_drops_orphans_and_computes_flags(g):
    e = _by_id(g.int_encounters_enriched, "encounter_id")
    assert "e99" not in e
    assert e["e41"]["duration_minutes"] == 0 and e["e41"]["has_invalid_timestamps"] is False
    assert e["e41"]["age_at_encounter"] == 1
    assert e["e42"]["duration_minutes"] is None and e["e42"]["has_invalid_timestamps"] is None
    assert e["e42"]["age_at_encounter"] is None
    assert e["e31"]["age_at_encounter"] < 0
    assert e["e51"]["has_invalid_timestamps"] is None


def test_readmission_flags(g):
    r = _by_id(g.fct_readmissions, "index_stay_id")
    # 0-day gap at the discharge instant: readmitted, not overlapping
    assert r["e11"]["days_to_readmission"] == 0 and r["e11"]["overlaps_next_stay"] is False
    assert r["e11"]["is_readmitted_30d"] is True
    assert r["e12"]["days_to_readmission"] == 30 and r["e12"]["is_readmitted_30d"] is True
    assert r["e13"]["days_to_readmission"] == 31 and r["e13"]["is_readmitted_30d"] is False
    # next stay planned (seed) -> all-cause true, unplanned false
    assert r["e13"]["readmission_encounter_code"] == "410410006"
    # last stay: no next, planned false, days NULL
    assert r["e14"]["readmission_stay_id"] is None and r["e14"]["is_planned_readmission"] is False
    assert r["e14"]["days_to_readmission"] is None and r["e14"]["stay_sequence"] == 4
    # died on discharge day -> excluded
    assert r["e21"]["died_during_index_stay"] is True and r["e21"]["is_eligible_index_stay"] is False
    assert r["e21"]["is_readmitted_30d"] is False
    # STOP NULL -> not eligible, no overlap
    assert r["e51"]["is_eligible_index_stay"] is False and r["e51"]["overlaps_next_stay"] is False
    # overlap: next admission before discharge
    assert r["e52"]["overlaps_next_stay"] is True and r["e52"]["days_to_readmission"] is None
    # next code absent from seed -> unplanned
    assert r["e52"]["readmission_encounter_code"] == "99999999"
    assert r["e52"]["is_planned_readmission"] is False
    # 23:00 -> 01:00 next day is one day; planned next stay
    assert r["e61"]["days_to_readmission"] == 1
    assert r["e61"]["is_readmitted_30d"] is True and r["e61"]["is_readmitted_30d_unplanned"] is False


def test_null_start_stay_is_ordered_last_and_band_80(spark):
    pats = [patient("q1")]
    encs = [encounter("a", "q1", None, "2020-02-01 08:00"), encounter("b", "q1", "2020-01-01 08:00",
                                                                     "2020-01-02 08:00")]
    g = ModelGraph(spark, raw_tables(spark, pats, encs), as_of="2024-01-01")
    r = _by_id(g.fct_readmissions, "index_stay_id")
    assert r["b"]["stay_sequence"] == 1 and r["a"]["stay_sequence"] == 2
    assert r["a"]["age_band_at_stay"] == "80+"
    assert r["a"]["is_eligible_index_stay"] is None  # NULL start: invalid flag unknown
    assert r["a"]["is_readmitted_30d"] is False


def test_organization_kpis_quirks(g):
    k = _by_id(g.mart_organization_kpis, "organization_id")
    # o2 has encounters (emergency) but no eligible stay: counts 0, rates NULL
    assert k["o2"]["total_encounters"] == 1 and k["o2"]["emergency_encounters"] == 1
    assert k["o2"]["eligible_inpatient_stays"] == 0 and k["o2"]["readmission_rate_30d_pct"] is None
    assert k["o2"]["emergency_share_pct"] == 100.0
    assert k["o1"]["readmission_rate_30d_unplanned_pct"] <= k["o1"]["readmission_rate_30d_pct"]


def test_org_without_encounters_keeps_null_activity(spark):
    pats = [patient("z1")]
    encs = [encounter("x", "z1", "2020-01-01 08:00", "2020-01-02 08:00")]
    g = ModelGraph(spark, raw_tables(spark, pats, encs), as_of="2024-01-01")
    k = _by_id(g.mart_organization_kpis, "organization_id")
    assert k["o2"]["total_encounters"] is None and k["o2"]["eligible_inpatient_stays"] == 0


def test_dim_patients_age_at_as_of_or_death(g):
    p = _by_id(g.dim_patients, "patient_id")
    assert p["p1"]["age_years"] == 2024 - 1950 and p["p1"]["age_band"] == "65-79"
    assert p["p2"]["age_years"] == 2020 - 1950
    assert p["p1"]["total_conditions"] == 0 and p["p1"]["is_polypathologic"] is False


def test_high_utilizers_median(g):
    h = _by_id(g.mart_high_utilizers, "patient_id")
    # p1 eligible stays: e11 (0), e12 (30), e13 (31), e14 (NULL) -> median 30, avg 20.3
    assert h["p1"]["inpatient_stays"] == 4 and h["p1"]["median_days_between_stays"] == 30.0
    assert h["p1"]["avg_days_between_stays"] == 20.3
    assert h["p1"]["is_high_utilizer"] is False


def test_identifiers_never_leave_staging(g):
    for name in ("stg_patients", "dim_patients", "int_encounters_enriched", "fct_readmissions",
                 "mart_high_utilizers"):
        cols = {c.lower() for c in g.model(name).columns}
        assert not cols & {"ssn", "first", "last", "address", "lat", "lon", "passport", "drivers"}, name


def test_models_queryable_as_sql_views(spark):
    from wardline.registry import graph
    from conftest import SF_SMALL
    g = graph(spark, SF_SMALL)
    names = g.register_views(prefix="wl_")
    assert "wl_fct_readmissions" in names
    n = spark.sql("select count(*) from wl_fct_readmissions where is_eligible_index_stay").first()[0]
    assert n == 529


def test_negative_age_fails_the_age_range_check(g):
    from wardline.operators import quality as Q
    from wardline.plans.checks import WAREHOUSE_CHECKS
    check = next(c for c in WAREHOUSE_CHECKS if c.name == "accepted_range_fct_encounters_age_at_encounter")
    rows = Q.failures(check, g.model).collect()
    assert len(rows) == 1 and rows[0]["n_records"] == 1
    bands = {r["index_stay_id"]: r["age_band_at_stay"] for r in g.fct_readmissions.collect()}
    enc = {r["encounter_id"]: r["age_at_encounter"] for r in g.fct_encounters.collect()}
    assert enc["e31"] < 0  # born after the encounter year; emergency, so not a stay
    from wardline.functions import age_band
    from pyspark.sql import functions as F
    assert g.fct_encounters.filter(F.col("encounter_id") == "e31").select(
        age_band("age_at_encounter")).first()[0] == "00-17"
    assert bands  # stays exist
