"""wardline — patient-care analytics as composable Spark DataFrame functions.

Layers follow the warehouse model: raw tables -> staging (typed, renamed,
direct identifiers dropped) -> intermediate -> marts, plus data-quality
checks, change capture and a near-real-time activity mart.  Every model is
a plain ``DataFrame -> DataFrame`` function so Catalyst sees the whole plan.
"""

__version__ = "0.1.0"
