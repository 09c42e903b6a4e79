"""Planned / unplanned classification of admission codes (the seed table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SEED_SCHEMA = T.StructType([
    T.StructField("encounter_code", T.StringType(), False),
    T.StructField("encounter_label", T.StringType(), True),
    T.StructField("is_planned", T.BooleanType(), False),
    T.StructField("classification_rationale", T.StringType(), True),
])

# The versioned seed rows (code, label, planned, rationale), in file order.
PLANNED_CLASSIFICATION = [
    ("56876005", "Drug rehabilitation and detoxification", True, "Therapie recurrente par nature programmee"),
    ("410410006", "Screening surveillance", True, "Depistage programme a l avance"),
    ("310061009", "Gynecology service", True, "Suivi programme incluant le prenatal"),
    ("183495009", "Non-urgent orthopedic admission", True, "Libelle explicitement non urgent donc electif"),
    ("86013001", "Periodic reevaluation and management", True, "Suivi periodique par definition programme"),
    ("185347001", "Encounter for problem", False, "Motif clinique actif - defaut non programme"),
    ("183452005", "Encounter Inpatient", False, "Code non qualifie - defaut conservateur non programme"),
    ("308540004", "Inpatient stay", False, "Code non qualifie - defaut conservateur non programme"),
    ("305408004", "Admission to surgical department", False, "Chirurgie non qualifiee electif vs urgent indistinguable"),
    ("185345009", "Encounter for symptom", False, "Admission motivee par un symptome - non programme"),
    ("32485007", "Hospital admission", False, "Code non qualifie - defaut conservateur non programme"),
    ("305411003", "Admission to thoracic surgery department", False, "Chirurgie non qualifiee electif vs urgent indistinguable"),
]


def planned_classification(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The seed as a DataFrame with pinned types.

    With ``path`` the seed is loaded from CSV by column name (codes stay
    strings, ``is_planned`` is cast to boolean, a bad value aborts);
    otherwise the versioned rows above are used.  Either way it is a small local relation that the
    planner broadcasts by size.
    """
    if path:
        from wardline.sources.csv import load_by_name
        return load_by_name(spark, path, SEED_SCHEMA)
    df = spark.createDataFrame(PLANNED_CLASSIFICATION, SEED_SCHEMA)
    # literal rows: no job needed to know their size
    df._known_bytes = sum(len(str(v).encode()) + 32 for row in PLANNED_CLASSIFICATION for v in row)
    return df
