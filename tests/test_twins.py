"""Queries against their SQL twins. ALL_TWINS=1 runs every one of them."""

import os

import pytest
from compare import differences, open_twin
from conftest import FOLDER

from merchtide import queries

queries.load()

# One query per operator family; the long builds run with ALL_TWINS.
USUAL = """
src01_csv_scan src03_append_new_column src06_schema_record src08_json_metadata src10_upsert_snapshot
src16_partitioned_layout prj01_normalize_names prj02_cast_to_schema prj04_latest_snapshot
prj07_decision_ladder prj11_channel_shift prj17_top_by_rank ded01_newest_per_key
ded02_first_occurrences jn01_kpi_stock_left jn02_marketing_stock_left jn05_upsert_rows
jn07_batch_process_health jn09_document_matches jn09_conversation_matches jn10_keyword_join agg03_ratio_of_sums
agg07_demand_vs_stock agg09_orders_summary agg10_category_summary agg13_percentiles
agg14_duration_history agg15_slot_sums agg16_duplicate_keys win01_rank_per_hour
win03_ledger_floor win03_ledger_available win05_channel_share srt01_latest_kpi
srt10_drill_stock met02_push_score_cover met06_order_value dq01_not_null dq02_unique_key
dq03_non_negative aud01_audit_rows sla05_risk_score sla13_next_actions
fn04_tokens fn06_hash_slots fn14_hour_key fn15_parse_and_iso fn18_rounding fn20_dot_product
flow06_push_now flow08_budget_shift
""".split()


@pytest.fixture(scope="module")
def twin():
    return open_twin(FOLDER)


@pytest.mark.parametrize("name", list(queries.TWINS) if os.environ.get("ALL_TWINS") else USUAL)
def test_twin(spark, twin, name):
    assert differences(queries.QUERIES[name](spark, FOLDER), twin, queries.TWINS[name]) == []


def test_every_query_has_a_twin():
    assert set(queries.QUERIES) == set(queries.TWINS)


def test_flagship_is_stable(spark):
    from __spark_entry__ import entry

    first, second = entry(spark), entry(spark)
    assert first.schema == second.schema
    assert sorted(first.collect(), key=repr) == sorted(second.collect(), key=repr)
