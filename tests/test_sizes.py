"""Queries held against their SQL on tables that the small ones don't stand for: wide keys, ties, long groups."""

import tracemalloc
from unittest.mock import MagicMock

import duckdb
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomframe.functions import text
from loomframe.operators import review
from loomframe.plans import catalog
from loomframe.streaming import run_state

from .conftest import DATA
from .test_oracles import TABLES, plain


@pytest.fixture
def grown(tmp_path):
    """Folder of the small tables in which some are replaced by a query over them."""

    def make(**replaced: str) -> str:
        con = duckdb.connect()
        for name in [*TABLES, "conversations"]:
            con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
        for name in [*TABLES, "conversations"]:
            con.sql(f"COPY ({replaced.get(name, f'SELECT * FROM {name}')}) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
        return str(tmp_path)

    return make


def same_as_sql(spark, folder: str, name: str) -> None:
    con = duckdb.connect()
    for table in [*TABLES, "conversations"]:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    ours, theirs = plain(catalog.QUERIES[name](spark, folder).toPandas()), plain(con.sql(catalog.ORACLES[name]).df())
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False)


def test_paths_of_wide_numbers(spark, grown):
    same_as_sql(spark, grown(orders="SELECT * REPLACE (o_orderkey * 997 AS o_orderkey) FROM orders LIMIT 3000"), "path_resolution")


@pytest.mark.parametrize("name", ["target_only_timeline", "pick_place_timeline"])
def test_motion_as_strong_as_the_threshold(spark, grown, name):
    same_as_sql(spark, grown(events="SELECT * REPLACE (event_id + g * 10000 AS event_id) FROM events, range(20) r(g)"), name)


def times_in_plan(frame, word: str) -> int:
    """How often the optimized plan has a word."""
    return frame._jdf.queryExecution().optimizedPlan().toString().count(word)


@pytest.mark.parametrize(("name", "most"), [("choice_answers", 1), ("box_answers", 2)])
def test_answers_are_read_once(spark, name, most):
    assert times_in_plan(catalog.QUERIES[name](spark, DATA), "from_json(") <= most


def test_recordings_are_read_once(spark):
    plan = catalog.QUERIES["loop_contexts"](spark, DATA)
    assert times_in_plan(plan, "parseJson(") == 1
    assert times_in_plan(plan, "get_json_object(") == 0


def test_slugs_hold_one_text_at_a_time():
    texts = pa.array(["Été à la plage " * 2000] * 100)
    tracemalloc.start()
    try:
        found = text._slugs(96).func(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert set(found.to_pylist()) == {("ete_a_la_plage_" * 7)[:96].rstrip("_")}
    assert peak < texts.nbytes / 4


def test_worker_asks_its_state_once_for_many_receipts():
    handle, worker = MagicMock(), run_state.Worker(1000)
    handle.getValueState.return_value.get.return_value = None
    handle.getValueState.return_value.exists.return_value = False
    handle.getMapState.return_value.containsKey.return_value = False
    worker.init(handle)
    at = pd.to_datetime(pd.Series(range(2000)), unit="s").astype("datetime64[us]")
    rows = pd.DataFrame({"at": at, "seq": range(2000), "status": "completed", "error": None})
    found = next(worker.handleInputRows((7,), iter([rows[:900], rows[900:], rows[:5]]), None)).iloc[0]
    assert (found["episode"], found["receipts"], found["status"]) == (7, 2000, "complete")
    assert len(handle.mock_calls) < 20


def test_lists_of_cases_count_what_is_unknown_by_itself(spark):
    assert times_in_plan(catalog.QUERIES["case_lists"](spark, DATA), "Join LeftAnti") == 1
    cases = spark.createDataFrame([(1, 1, 2), (1, 2, 2), (2, 1, 2), (2, 1, 2), (3, 9, 1), (4, 1, 2), (None, 9, 1)], "list long, episode long, declared int")
    known = spark.createDataFrame([(1,), (2,), (2,)], "episode long")
    found = {r["list"]: r["reason"] for r in review.case_list(cases, known, F.col("declared")).collect()}
    assert found == {1: None, 2: "repeated", 3: "unknown", 4: "count", None: "unknown"}
