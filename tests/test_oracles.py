"""Registered queries against DuckDB. Set NETSIEVE_ALL_ORACLES=1 for all of them."""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck

STATEMENTS = entry.oracle_sql()
CHOSEN = [
    "a2_flow_csv_source", "a3_firewall_csv_source", "a4_a5_payload_source", "a6_inference_json_source", "a8_start_from_latest",
    "c8_unified_record_keywords", "c9_flow_table", "c10_flow_csv", "c11_firewall_log", "c13_generic", "c16_d_all_features",
    "d16_d33_page_urls", "e1_protocol_codes", "e3_ports_per_source", "e5_fit_transform_same_rows", "e6_state_summary",
    "f2_key_lookup_hot_keys", "g1_sample_weights", "g10_classification_report", "j1_stratified_split", "l3_l4_choice_and_decision",
    "m12_firewall_mapper", "m13_ids_mapper", "m14_single_ids_mapper", "n2_stream_deduplicate", "n9_notification_text",
    "n10_ids_notification_text", "attack_ranking",
]
NAMES = list(STATEMENTS) if os.environ.get("NETSIEVE_ALL_ORACLES") else CHOSEN


@pytest.fixture(scope="module")
def connection(small):
    return duck(small)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, small, connection, name):
    assert compare(entry.queries()[name](spark, small), connection, STATEMENTS[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_a_name_and_reads_the_tables():
    assert set(STATEMENTS) <= set(entry.queries())
