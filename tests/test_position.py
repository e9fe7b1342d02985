"""Range-based running totals, row frames and percentiles against pandas."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from newslake.operators import position


@pytest.fixture(scope="module")
def hot(spark):
    """One key holds most rows, one key is null."""
    rng = np.random.default_rng(7)
    n = 3000
    frame = pd.DataFrame({
        "key": np.where(rng.random(n) < 0.8, "hot", rng.choice(["a", "b"], n)),
        "t": rng.integers(0, 50, n),
        "id": np.arange(n),
        "x": np.round(rng.random(n), 1),
    })
    return frame, spark.createDataFrame(frame).repartition(6).cache()


def test_numbered(hot):
    frame, df = hot
    got = position.numbered(df, ["key"], ["t", "id"]).toPandas().set_index("id")["position"]
    want = frame.sort_values(["t", "id"]).groupby("key").cumcount() + 1
    assert got.sort_index().tolist() == want.sort_index().tolist()


def test_numbered_with_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "key string, id int")
    got = {r["id"]: r["position"] for r in position.numbered(df, ["key"], ["id"]).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


@pytest.mark.parametrize("block_rows", [7, 100, 1_000_000])
def test_row_frames(hot, block_rows):
    frame, df = hot
    made = {
        "mean": lambda w: F.avg("x").over(w.rowsBetween(-4, 0)),
        "before": lambda w: F.lag("id").over(w),
    }
    got = position.row_frames(df, ["key"], ["t", "id"], 4, made, block_rows).toPandas()
    got = got.set_index("id").sort_index()
    grouped = frame.sort_values(["t", "id"]).groupby("key")
    mean = grouped["x"].rolling(5, min_periods=1).mean().droplevel(0).sort_index()
    assert len(got) == len(frame)
    assert np.allclose(got["mean"], mean)
    before = grouped["id"].shift().sort_index()
    assert np.array_equal(got["before"].fillna(-1), before.fillna(-1))


@pytest.mark.parametrize("preceding, block_rows", [(10, 4), (9, 3), (4, 4)])
def test_frames_longer_than_a_block(hot, preceding, block_rows):
    frame, df = hot
    frame, df = frame[frame["id"] < 200], df.where("id < 200")
    made = {"n": lambda w: F.count("*").over(w.rowsBetween(-preceding, 0)), "sum": lambda w: F.sum("id").over(w.rowsBetween(-preceding, 0))}
    got = position.row_frames(df, ["key"], ["t", "id"], preceding, made, block_rows).toPandas().set_index("id").sort_index()
    moving = frame.sort_values(["t", "id"]).groupby("key")["id"].rolling(preceding + 1, min_periods=1)
    assert len(got) == len(frame)
    assert np.array_equal(got["n"], moving.count().droplevel(0).sort_index())
    assert np.array_equal(got["sum"], moving.sum().droplevel(0).sort_index())


def test_percentiles(hot):
    frame, df = hot
    got = position.percentiles(df, ["key"], "x", [0.0, 0.5, 0.95, 1.0]).collect()
    assert len(got) == 12
    for row in got:
        want = np.percentile(frame[frame["key"] == row.key]["x"], row.point * 100)
        assert row.percentile == pytest.approx(want, abs=1e-6)
