"""Plan properties of the registered queries, from explain() output."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from ratingflow.plans.queries import QUERIES as RATING_QUERIES

SF = "/root/testdata/sf0.001"
QUERIES = {name: fn for name, fn in entry.queries().items() if name in RATING_QUERIES}


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    # the grid search fits 15 models just to build its frame; its plan is a
    # local relation, so it is left out of the sweep
    return {name: plan(fn(spark, SF)) for name, fn in QUERIES.items() if name != "als_grid_search"}


def test_no_cartesian_product_anywhere(plans):
    assert not [n for n, p in plans.items() if "CartesianProduct" in p]


def test_no_nested_loop_join_anywhere(plans):
    assert not [n for n, p in plans.items() if "BroadcastNestedLoopJoin" in p]


@pytest.mark.parametrize("name", ["stream_candidates", "stream_recs", "stream_candidates_hub"])
def test_rated_movies_are_dropped_in_the_join(plans, name):
    tree = plans[name]
    assert "bitmap_construct_agg" in tree and "LeftAnti" not in tree
    # the filters on the movie's own ranking and on the user's bits are the join's
    joins = [x for x in tree.split("\n\n") if "Join condition" in x and "_place" in x]
    assert joins and all("seen" in x for x in joins)


def test_candidates_need_few_shuffles(plans):
    tree = plans["stream_candidates"].split("\n\n")[0]
    assert tree.count("Exchange") < 19


@pytest.mark.parametrize("name", ["genre_top_movies", "recent_ratings"])
def test_top_k_limits_before_the_shuffle(plans, name):
    tree = plans[name].split("\n\n")[0]
    assert tree.count("WindowGroupLimit") >= 2   # partial (map side) + final


@pytest.mark.parametrize("name", ["rating_count_by_movie", "rating_count_by_month",
                                  "average_score_by_movie", "like_dislike_counts"])
def test_aggregates_are_partial_then_final(plans, name):
    tree = plans[name].split("\n\n")[0]
    assert tree.count("HashAggregate") == 2 and "Exchange" in tree


def test_scans_read_only_needed_columns(plans):
    p = plans["movie_tag_documents"]
    assert "ReadSchema: struct<event_type:string,props:string>" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plans["rating_count_by_movie"]
