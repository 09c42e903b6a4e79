"""The warehouse's data-quality suite: 53 generic checks and 3 singular ones."""

from __future__ import annotations

from wardline.functions.clinical import AGE_BANDS
from wardline.operators.quality import Check

# Accepted domains.
GENDERS = ("M", "F")
ENCOUNTER_CLASSES = ("ambulatory", "emergency", "inpatient", "outpatient", "wellness",
                     "urgentcare", "hospice", "snf", "home", "virtual")


def _key(model: str, column: str) -> list[Check]:
    return [Check("unique", model, column), Check("not_null", model, column)]


def _rel(model: str, column: str, to: str, field: str) -> Check:
    return Check("relationships", model, column, to=to, field=field)


def _range(model: str, column: str, lo=None, hi=None) -> Check:
    return Check("accepted_range", model, column, min_value=lo, max_value=hi)


WAREHOUSE_CHECKS: list[Check] = [
    # staging
    *_key("stg_patients", "patient_id"),
    Check("not_null", "stg_patients", "birth_date"),
    Check("accepted_values", "stg_patients", "gender", values=GENDERS),
    *_key("stg_encounters", "encounter_id"),
    Check("not_null", "stg_encounters", "patient_id"),
    _rel("stg_encounters", "patient_id", "stg_patients", "patient_id"),
    Check("accepted_values", "stg_encounters", "encounter_class", values=ENCOUNTER_CLASSES),
    Check("not_null", "stg_conditions", "patient_id"),
    _rel("stg_conditions", "patient_id", "stg_patients", "patient_id"),
    Check("not_null", "stg_conditions", "condition_code"),
    Check("not_null", "stg_medications", "patient_id"),
    _rel("stg_medications", "patient_id", "stg_patients", "patient_id"),
    *_key("stg_organizations", "organization_id"),
    # marts
    *_key("dim_patients", "patient_id"),
    Check("accepted_values", "dim_patients", "age_band", values=tuple(AGE_BANDS)),
    Check("not_null", "dim_patients", "total_conditions"),
    *_key("dim_organizations", "organization_id"),
    *_key("fct_encounters", "encounter_id"),
    Check("not_null", "fct_encounters", "patient_id"),
    _rel("fct_encounters", "patient_id", "dim_patients", "patient_id"),
    _rel("fct_encounters", "organization_id", "dim_organizations", "organization_id"),
    _range("fct_encounters", "duration_minutes", lo=0),
    Check("accepted_values", "fct_encounters", "has_invalid_timestamps", values=(False,), severity="warn"),
    _range("fct_encounters", "age_at_encounter", lo=0, hi=120),
    *_key("fct_readmissions", "index_stay_id"),
    Check("not_null", "fct_readmissions", "patient_id"),
    _rel("fct_readmissions", "patient_id", "dim_patients", "patient_id"),
    _range("fct_readmissions", "days_to_readmission", lo=0),
    Check("accepted_values", "fct_readmissions", "age_band_at_stay", values=tuple(AGE_BANDS)),
    Check("not_null", "fct_readmissions", "is_readmitted_30d"),
    Check("not_null", "fct_readmissions", "is_readmitted_30d_unplanned"),
    Check("not_null", "fct_readmissions", "is_planned_readmission"),
    Check("not_null", "fct_readmissions", "is_eligible_index_stay"),
    *_key("mart_organization_kpis", "organization_id"),
    _range("mart_organization_kpis", "readmission_rate_30d_pct", 0, 100),
    _range("mart_organization_kpis", "readmission_rate_30d_unplanned_pct", 0, 100),
    _range("mart_organization_kpis", "emergency_share_pct", 0, 100),
    *_key("mart_high_utilizers", "patient_id"),
    _range("mart_high_utilizers", "inpatient_stays", lo=1),
    Check("not_null", "mart_high_utilizers", "is_high_utilizer"),
    _range("mart_high_utilizers", "personal_readmission_rate_pct", 0, 100),
    # seed
    *_key("seed_encounter_planned_classification", "encounter_code"),
    Check("not_null", "seed_encounter_planned_classification", "is_planned"),
    # singular
    Check("singular", "fct_readmissions", severity="warn", name_override="assert_overlap_rate_within_bounds"),
    Check("singular", "fct_encounters", name_override="assert_seed_covers_inpatient_codes"),
    Check("singular", "mart_organization_kpis", name_override="assert_unplanned_rate_lte_allcause"),
]


# The file-based copy of the warehouse runs the same generic checks plus a
# warn-level accepted_values on overlaps_next_stay, and no overlap-rate test.
LOCAL_CHECKS: list[Check] = [
    *[c for c in WAREHOUSE_CHECKS if c.name != "assert_overlap_rate_within_bounds"],
    Check("accepted_values", "fct_readmissions", "overlaps_next_stay", values=(False,), severity="warn"),
]


def checks_of_kind(kind: str) -> list[Check]:
    return [c for c in WAREHOUSE_CHECKS if c.kind == kind]
