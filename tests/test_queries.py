"""Registered queries against their SQL at the smallest scale; all of them: ``oracle_check.py``."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
SAMPLE = [
    "ingest_raw_lines", "ingest_raw_lines_observed", "stamp_clocks", "ingest_jsonl", "ingest_jsonl_rejects",
    "ingest_stats", "export_jsonl", "export_jsonl_ascii", "causal_order", "order_audit_time", "clock_relation",
    "relation_counts_lossy", "causal_slice", "merge_clocks", "causal_graph_lossy", "clock_audit_restamped",
    "missing_ticks", "log_query", "metadata_groups", "build_inverted_index", "keyword_search", "clock_audit_incomplete",
    "causal_ranges_lossy", "causal_slice_restamped", "relation_counts_incomplete", "order_audit_restamped", "pairs_within",
    "log_query_causal_first", "replay_clocks_lossy", "keyword_blocks", "stream_to_store",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    from causal_logs.oracles import ORACLES
    from causal_logs.queries import QUERIES

    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", SAMPLE)
def test_same_as_sql(spark, con, name):
    columns, sql_columns, rows, sql_rows = compare(spark, con, name, SF)
    assert columns == sql_columns and rows == sql_rows


def test_entry(spark):
    assert entry.entry(spark).columns == ["event_id", "eff_ts", "pos"]
