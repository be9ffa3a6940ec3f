"""Literal cases of event detection, masks, gates and sampling."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomframe.operators import kernels, masks, quality, sequence

LOOP = [1.0] * 4 + [0.7, 0.1, 0.1, 0.1, 0.4, 0.95, 0.95, 0.95]


def grips(spark, *series):
    return spark.createDataFrame([(e, f, float(g)) for e, s in enumerate(series) for f, g in enumerate(s)], "episode long, frame long, grip double")


@pytest.mark.parametrize(
    ("grip", "expected"),
    [
        ([1.0] * 5 + [0.7, 0.4, 0.1, 0.1, 0.1, 0.3, 0.6, 0.95, 0.95, 0.95], (5, 9, 10, 14)),
        ([1.0, 1.0, 0.2] + [1.0] * 2 + [0.7, 0.4, 0.1, 0.1, 0.1, 0.3, 0.6, 0.95, 0.95, 0.95], (5, 9, 10, 14)),
        ([1.0] * 4 + [0.7, 0.15, 0.15, 0.15, 0.4, 0.9, 0.9, 0.9], (4, 7, 8, 11)),
    ],
)
def test_loop_events(spark, grip, expected):
    row = sequence.loop_events(grips(spark, grip)).first()
    assert tuple(row)[1:5] == expected
    assert row["outcome"] == "loop"


def test_failed_loops_have_their_own_outcomes(spark):
    stable = [1.0] * 4 + [0.7] + [0.2] * 8
    closed = [1.0] * 4 + [0.7] + [0.1] * 8
    partly = [1.0] * 4 + [0.7] + [0.1] * 4 + [0.8] * 5
    rows = sequence.loop_events(grips(spark, [1.0] * 12, stable, closed, partly)).orderBy("episode").collect()
    assert [r["outcome"] for r in rows] == ["no_close", "no_stable_close", "no_open", "no_stable_open"]


def test_repeated_loops_and_incomplete_tail(spark):
    rows = sequence.repeated_loops(grips(spark, LOOP + [1.0] * 3 + LOOP, LOOP + [1.0] * 7 + [0.7, 0.1, 0.1, 0.1])).orderBy("episode", "loop").collect()
    assert [tuple(r)[:5] for r in rows] == [(4, 7, 8, 11, 0), (19, 22, 23, 26, 0), (4, 7, 8, 11, 1)]


def test_target_only(spark):
    hold = [1.0] * 5 + [0.7, 0.4] + [0.1] * 9
    reopened = [1.0] * 5 + [0.7, 0.4, 0.1, 0.1, 0.1, 0.4, 0.95, 0.95, 0.95, 0.95, 0.95]
    rows = sequence.target_only_events(grips(spark, hold, reopened)).orderBy("episode").collect()
    assert [(r["close_start"], r["close_end"], r["accepted"]) for r in rows] == [(5, 9, True), (5, 9, False)]


def test_motion_start_wraps_angles(spark):
    turn = F.array(F.lit(0.0), F.lit(0.0), F.lit(3.0415926))
    before = F.array(F.lit(0.0), F.lit(0.0), F.lit(-3.1415926))
    zero = F.array(*[F.lit(0.0)] * 3)
    assert spark.range(1).select(sequence.motion_score(zero, turn, zero, before)).first()[0] == pytest.approx(0.05 * 0.1, abs=1e-6)


@pytest.mark.parametrize(("a", "b", "expected"), [(0, 52, [0, 17, 35, 52]), (3, 3, [3]), (5, 4, []), (0, 1, [0, 1])])
def test_uniform_sample(spark, a, b, expected):
    assert spark.range(1).select(sequence.uniform_sample(F.lit(a), F.lit(b), 4)).first()[0] == expected


def test_iou(spark):
    row = spark.createDataFrame([(0b0011, 0b0110), (0, 0)], "a long, b long").select(masks.iou(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in row] == [pytest.approx(1 / 3), 1.0]


def test_temporal_qc(spark):
    block = 0b11 | 0b11 << 8
    review = [(0, f, block if f != 1 else 0) for f in range(4)]
    corner = sum(0b1111 << (8 * y + 4) for y in range(4, 8))
    corner = corner - 2**64 if corner >= 2**63 else corner
    rows = masks.temporal_qc(spark.createDataFrame(review + [(1, f, 1 if f % 2 else corner) for f in range(4)], "episode int, frame int, mask long")).orderBy("episode").collect()
    assert (rows[0]["status"], rows[0]["coverage"], rows[0]["presence_transitions"], rows[0]["internal_missing_frames"]) == ("review", 0.75, 2, 1)
    assert rows[1]["status"] == "quarantine"


def test_gate_takes_the_first_reason(spark):
    rows = spark.createDataFrame([(0, None), (2, 1), (99, 1), (50, 1), (50, None)], "area int, dup int").select(quality.mechanical_gate(F.col("area"), 10, 90, F.col("dup")))
    assert [r[0] for r in rows.collect()] == ["empty", "too_small", "too_large", "duplicate", "valid"]


def test_suppressed_candidates_do_not_suppress(spark):
    rows = [("g", 1, 0b1111, True), ("g", 2, 0b0111, True), ("g", 3, 0b0011, True), ("g", 4, 0b1111, False)]
    found = kernels.suppress_duplicates(spark.createDataFrame(rows, "group string, id long, mask long, valid boolean"), "group", 0.7).orderBy("id").collect()
    assert [r["duplicate_of"] for r in found] == [None, 1, None, None]


def test_masks_of_other_frames_do_not_suppress(spark):
    from loomframe.plans import catalog

    rows = catalog.QUERIES["duplicate_suppression"](spark, "/root/testdata/sf0.001").collect()
    frame = {r["id"]: (r["episode"], r["frame"]) for r in rows}
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").count()
    assert max(sum(f == g for g in frame.values()) for f in set(frame.values())) <= 8
    found = [r for r in rows if r["duplicate_of"] is not None]
    assert found
    assert all(frame[r["duplicate_of"]] == (r["episode"], r["frame"]) for r in found)
