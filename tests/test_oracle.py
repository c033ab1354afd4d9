"""Spark queries against their DuckDB oracle SQL at sf0.001 (a representative set).

``python tests/oracle_check.py`` runs all at sf0.01, like the driver.
"""

from paths import SF001
from oracle_check import compare

QUERIES = ["prepare_records", "composite_key", "group_quartiles", "lead_gap", "gap_scores",
           "gap_outliers_by_user", "make_grid", "raster_cell_join", "export_wide",
           "cumulative_frequency", "ids_json_per_source", "detector_overlap", "row_count", "write_counters",
           "restarted_write", "quarantine_rows", "csv_id_list", "ordered_labels", "approx_quartiles",
           "bucketed_export", "box_lookup", "natural_merge", "job_export"]


def test_oracle(spark):
    assert compare(spark, SF001, QUERIES) == []
