import duckdb
import pytest

import __spark_entry__ as registered
import check
from conftest import SF

QUICK = ["clean_flights", "attach_hotels", "user_features", "gender_features", "dq_bounds", "dq_referential",
         "numeric_summary", "corr_matrix", "monthly_trips", "ranker_eval", "score_requests_validate",
         "score_recommend", "score_classification", "fold_stratified", "split_grouped", "char_ngram_idf"]


@pytest.mark.parametrize("name", QUICK)
def test_oracle(spark, name):
    text, ok, _ = check.compare(spark, check.connect(SF), name, registered.queries()[name],
                                registered.oracle_sql()[name], SF)
    assert ok, text


def test_every_oracle_has_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())
    assert registered.entry is not None and duckdb is not None


def explained(spark, name):
    df = registered.queries()[name](spark, SF)
    return df._jdf.queryExecution().toString()


def test_no_cross_joins(spark):
    for name in ("user_features", "route_count", "class_mix_ladder", "attach_hotels", "score_requests_validate"):
        plan = explained(spark, name)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_scans_read_only_what_they_need(spark):
    plan = explained(spark, "revenue_by_agency")
    assert "l_shipdate" not in plan.split("== Physical Plan ==")[1]
    plan = explained(spark, "hotel_economics").split("== Physical Plan ==")[1]
    assert "EqualTo(l_returnflag,R)" in plan  # pushed into the scan
    assert "customer" not in plan


def test_per_user_limit_runs_before_the_shuffle(spark):
    assert "WindowGroupLimit" in explained(spark, "item_cf_top_k")
