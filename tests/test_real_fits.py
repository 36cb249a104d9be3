"""Real fits of points whose best models are known: results, not facts about them."""

import pytest

from conftest import SF_SMALL
from oracle_compare import compare, duck
from segmint.operators import train as TR
from segmint.plans import queries as Q
from segmint.plans.oracle import SQL
from segmint.session import materialize


@pytest.fixture(scope="module")
def points(spark):
    return materialize(Q._towns(spark, SF_SMALL))


def test_the_choice_is_checked(spark, points):
    """The SQL states one k: the models of its neighbours don't pass for it."""
    con = duck(SF_SMALL)
    assert con.execute(SQL["select_k"]).fetchall()[0][0] == 3
    for k in (2, 3, 4):
        ok, _ = compare(Q._model_rows(spark, [TR.train_kmeans_default(points, k, Q.TRAIN_ITER)]), con, SQL["select_k"])
        assert ok == (k == 3)


def test_one_more_centre_or_a_moved_one_is_seen(spark, points):
    con = duck(SF_SMALL)
    rows = Q.q_train_kmeans(spark, SF_SMALL)
    assert compare(rows, con, SQL["train_kmeans"])[0]
    moved = rows.withColumn("center", rows["center"] + 1e-3)
    assert not compare(moved, con, SQL["train_kmeans"])[0]
    assert not compare(Q._model_rows(spark, [TR.compute_next_model(points, k, Q.TRAIN_ITER) for k in (2, 3)]), con, SQL["compute_next_model"])[0]
