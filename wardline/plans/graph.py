"""The model graph: every model as a lazily built, reused DataFrame.

Views (staging, intermediate) are plain lazy DataFrames; each consumer
folds them into its own plan, so Catalyst prunes and pushes filters down
to the raw scans.  ``plans.build`` materializes the marts as tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from wardline.operators import intermediate as I
from wardline.operators import marts as M
from wardline.operators import staging as S
from wardline.sources.catalog import RawTables
from wardline.sources.seed import planned_classification


class ModelGraph:
    def __init__(self, spark: SparkSession, raw: RawTables, planned: DataFrame | None = None,
                 as_of=None):
        self.spark = spark
        self.raw = raw
        self._planned = planned
        self.as_of = as_of

    # staging -------------------------------------------------------------
    @cached_property
    def stg_patients(self) -> DataFrame:
        return S.stg_patients(self.raw["patients"])

    @cached_property
    def stg_encounters(self) -> DataFrame:
        return S.stg_encounters(self.raw["encounters"])

    @cached_property
    def stg_conditions(self) -> DataFrame:
        return S.stg_conditions(self.raw["conditions"])

    @cached_property
    def stg_medications(self) -> DataFrame:
        return S.stg_medications(self.raw["medications"])

    @cached_property
    def stg_organizations(self) -> DataFrame:
        return S.stg_organizations(self.raw["organizations"])

    @cached_property
    def seed_planned(self) -> DataFrame:
        return self._planned if self._planned is not None else planned_classification(self.spark)

    # intermediate --------------------------------------------------------
    @cached_property
    def int_encounters_enriched(self) -> DataFrame:
        return I.int_encounters_enriched(self.stg_encounters, self.stg_patients)

    @cached_property
    def int_inpatient_stays(self) -> DataFrame:
        return I.int_inpatient_stays(self.int_encounters_enriched)

    @cached_property
    def int_patient_condition_summary(self) -> DataFrame:
        return I.int_patient_condition_summary(self.stg_conditions)

    # marts ---------------------------------------------------------------
    @cached_property
    def dim_patients(self) -> DataFrame:
        return M.dim_patients(self.stg_patients, self.int_patient_condition_summary, self.as_of)

    @cached_property
    def dim_organizations(self) -> DataFrame:
        return M.dim_organizations(self.stg_organizations)

    @cached_property
    def fct_encounters(self) -> DataFrame:
        return M.fct_encounters(self.int_encounters_enriched)

    @cached_property
    def fct_readmissions(self) -> DataFrame:
        return M.fct_readmissions(self.int_inpatient_stays, self.dim_patients, self.seed_planned)

    @cached_property
    def mart_organization_kpis(self) -> DataFrame:
        return M.mart_organization_kpis(self.fct_readmissions, self.fct_encounters, self.dim_organizations)

    @cached_property
    def mart_high_utilizers(self) -> DataFrame:
        return M.mart_high_utilizers(self.fct_readmissions, self.dim_patients)

    @cached_property
    def mart_organization_kpis_rt(self) -> DataFrame:
        return M.mart_organization_kpis_rt(self.int_encounters_enriched, self.dim_organizations)

    @property
    def seed_encounter_planned_classification(self) -> DataFrame:
        return self.seed_planned

    def register_views(self, names=None, prefix: str = "") -> list[str]:
        """Register models as temporary views so they can be queried with SQL.

        Views stay lazy: each SQL query folds the model's plan into its own.
        """
        names = list(names or MODEL_NAMES)
        for n in names:
            self.model(n).createOrReplaceTempView(f"{prefix}{n}")
        return [f"{prefix}{n}" for n in names]

    def model(self, name: str) -> DataFrame:
        """Resolve a model by name (also the resolver used by quality checks)."""
        return getattr(self, name)


MODEL_NAMES = ("stg_patients", "stg_encounters", "stg_conditions", "stg_medications", "stg_organizations",
               "seed_encounter_planned_classification", "int_encounters_enriched", "int_inpatient_stays",
               "int_patient_condition_summary", "dim_patients", "dim_organizations", "fct_encounters",
               "fct_readmissions", "mart_organization_kpis", "mart_high_utilizers", "mart_organization_kpis_rt")
