"""The scale properties of the physical plans (see PLANS.md) stay true."""

import contextlib
import io

import pytest

from segmint.operators.assign import assign, first_rows_as_centers
from segmint.operators.features import embedding_points, user_actions
from segmint.operators.profile import cluster_profile, cluster_summary
from segmint.operators.runs import run_centers
from segmint.operators.train import centers_of, train_kmeans
from segmint.plans.monthly import month_counts

from conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture(scope="module")
def ua(spark):
    return user_actions(spark, SF_SMALL)


def test_features_one_shuffle_with_partial_aggregation(ua):
    p = plan(ua[0])
    assert p.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in p
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in p


def test_model_assignment_stays_in_the_jvm(spark):
    emb = embedding_points(spark, SF_SMALL)
    model = train_kmeans(emb, 8, seed=1)
    p = plan(assign(emb, model))
    assert "MapInArrow" not in p and "Python" not in p
    assert "BroadcastHashJoin" in p and "Exchange hashpartitioning" not in p


def test_profile_reads_the_data_once(ua):
    pts, dims = ua
    cents = first_rows_as_centers(pts, 4, "user_id")
    p = plan(cluster_profile(assign(pts, cents), cents, dims, "r"))
    assert p.count("FileScan parquet") == 1
    s = plan(cluster_summary(assign(pts, cents), 5))
    assert "partial_aggregate_metrics" in s or "partial_" in s


def test_first_rows_per_run_limit_before_shuffle(spark):
    p = plan(run_centers(embedding_points(spark, SF_SMALL), "label", "vec_id", 16))
    before_exchange = p.split("Exchange hashpartitioning(label")[1]
    assert "WindowGroupLimit" in before_exchange


def test_month_filter_reaches_the_scan(spark):
    p = plan(month_counts(spark, SF_SMALL, ["199601"]))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p or (
        "GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p
    )


def test_centres_table_is_small_and_broadcast(spark):
    emb = embedding_points(spark, SF_SMALL)
    model = train_kmeans(emb, 4, seed=1)
    assert len(centers_of(model)) == 4
    p = plan(cluster_profile(assign(emb, model), centers_of(model), spark.range(64).selectExpr(
        "cast(id as int) as dim", "cast(id as string) as dimension_id", "cast(id as string) as dimension_name"), "r"))
    assert p.count("FileScan parquet") == 1
    assert "BroadcastExchange" in p
