"""Hand-written raw rows for edge cases."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

from wardline.sources.catalog import RawTables

PATIENT_SCHEMA = ("id string, birthdate date, deathdate date, gender string, race string, ethnicity string, "
                  "marital string, ssn string, city string, state string, county string, zip string, "
                  "healthcare_expenses double, healthcare_coverage double")
ENCOUNTER_SCHEMA = ("id string, patient string, organization string, provider string, payer string, "
                    "encounterclass string, code string, description string, start timestamp_ntz, "
                    "stop timestamp_ntz, base_encounter_cost double, total_claim_cost double, "
                    "payer_coverage double, reasoncode string, reasondescription string")
CONDITION_SCHEMA = "patient string, encounter string, code string, description string, start date, stop date"
MEDICATION_SCHEMA = ("patient string, encounter string, payer string, code string, description string, "
                     "start timestamp_ntz, stop timestamp_ntz, base_cost double, payer_coverage double, "
                     "dispenses int, totalcost double, reasoncode string, reasondescription string")
ORG_SCHEMA = "id string, name string, city string, state string, zip string, revenue double, utilization int"


def ts(s: str | None):
    return None if s is None else dt.datetime.fromisoformat(s)


def d(s: str | None):
    return None if s is None else dt.date.fromisoformat(s)


def patient(pid, birth="1950-06-01", death=None, gender="F"):
    return (pid, d(birth), d(death), gender, "white", "nonhispanic", "S", "999-00-0000", "Lyon", "ARA", "Rhone",
            "01000", 100.0, 50.0)


def encounter(eid, pid, start, stop, cls="inpatient", code="185347001", org="o1", cost=100.0, cover=60.0):
    return (eid, pid, org, "pr", "py", cls, code, "desc", ts(start), ts(stop), 10.0, cost, cover, None, None)


def raw_tables(spark, patients, encounters, conditions=(), organizations=None):
    orgs = organizations if organizations is not None else [("o1", "Org 1", "Lyon", "ARA", "01", 1.0, 1),
                                                            ("o2", "Org 2", "Nice", "PACA", "02", 2.0, 2)]
    return RawTables.from_frames({
        "patients": spark.createDataFrame(list(patients), PATIENT_SCHEMA),
        "encounters": spark.createDataFrame(list(encounters), ENCOUNTER_SCHEMA),
        "conditions": spark.createDataFrame(list(conditions), CONDITION_SCHEMA),
        "medications": spark.createDataFrame([], MEDICATION_SCHEMA),
        "organizations": spark.createDataFrame(orgs, ORG_SCHEMA),
    })


__all__ = ["T"]
