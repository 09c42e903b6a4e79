"""Sources: test tables, the raw clinical mapping, CSV loading, the seed."""

from wardline.sources.catalog import RawTables
from wardline.sources.seed import planned_classification
from wardline.sources.testdata import TEST_TABLES, raw_from_testdata, read_test_table

__all__ = ["RawTables", "planned_classification", "TEST_TABLES", "raw_from_testdata", "read_test_table"]
