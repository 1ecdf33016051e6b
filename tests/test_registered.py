"""Registered queries against their SQL twins; all of them with ALL_QUERIES=1."""

import os

import pytest

import __spark_entry__ as entry
from oracle import check, connect

FEW = [
    "s8_latest_partition", "f10_label_encode_fit", "f25_ordered_tail_split", "q6_pooling_mean_long", "q9_behaviour_history_hot_users",
    "q11_negative_history", "x2_fm_second_order_long", "x9_attentional_fm", "p3_linear_fm_scoring", "p4_linear_fm_tower_scoring",
    "p6_fibinet", "p8_history_attention_scoring", "m2_roc_auc_impressions", "m9_multi_task_metrics", "o3_online_predict",
    "o5_weight_update_in_rounds",
]
NAMES = list(entry.queries()) if os.environ.get("ALL_QUERIES") else FEW


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, sf, name):
    diff, _, rows = check(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), sf)
    assert diff is None and rows >= 1 if name != "e4_id_range_check" else diff is None


def test_entry_and_names(spark):
    df = entry.entry(spark)
    assert df.columns == ["l_orderkey", "l_linenumber", "l_partkey", "score"] and df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
