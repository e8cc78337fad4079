"""Nearest reference points against a search through all of them."""

import random

import pytest
from pyspark.sql import functions as F

from millrace import constants as C
from millrace.operators import PointIndex, reverse_geocode
from millrace.operators import geo as geo_module
from millrace.operators.geo import nearest_point

CELL = 1_000_000
LARGE = {"small": False, "share": 0.05, "min_rows": 0}


def text(micro):
    sign, value = ("-" if micro < 0 else ""), abs(micro)
    return f"{sign}{value // 1_000_000}.{value % 1_000_000:06d}"


def brute(lng, lat, points):
    def near(p):
        return abs(p[1] // CELL - lng // CELL) <= 1 and abs(p[2] // CELL - lat // CELL) <= 1

    found = [((p[1] - lng) ** 2 + (p[2] - lat) ** 2, p[0]) for p in points if near(p)]
    return str(min(found)[1]) if found else C.NO_INFO


@pytest.fixture(scope="module")
def world(spark):
    """A crowd of points and logins in one small area, copies of one point, and a thin spread elsewhere."""
    rng = random.Random(8)
    points = [(i, rng.randrange(-5_000_000, 5_000_000), rng.randrange(-5_000_000, 5_000_000)) for i in range(60)]
    points += [(100 + i, 2_000_000 + rng.randrange(50_000), 2_000_000 + rng.randrange(50_000)) for i in range(400)]
    points += [(1000 + i, -3_000_000, -3_000_000) for i in range(50)]
    asked = [(rng.randrange(-5_000_000, 5_000_000), rng.randrange(-5_000_000, 5_000_000)) for _ in range(150)]
    asked += [(2_000_000 + rng.randrange(-100_000, 150_000), 2_000_000 + rng.randrange(-100_000, 150_000)) for _ in range(150)]
    asked += [(-3_000_000, -3_000_000)] * 150 + [(40_000_000, 40_000_000)] + [(p[1], p[2]) for p in points[:20]]
    geo = spark.createDataFrame(
        [(i, x, y, str(i), f"c{i}", "[]", "") for i, x, y in points],
        "geo_id long, lng_e6 long, lat_e6 long, province string, city string, district string, address string",
    )
    logins = spark.createDataFrame([(n, text(x), text(y)) for n, (x, y) in enumerate(asked)], "n int, lng string, lat string")
    return geo, logins, {n: brute(x, y, points) for n, (x, y) in enumerate(asked)}


def answers(df):
    return {r["n"]: r["province"] for r in df.collect()}


def test_small_table(world, monkeypatch):
    geo, logins, want = world
    monkeypatch.setattr(geo_module, "POINTS_PER_ROW", 10_000)
    index = PointIndex.build(geo, CELL)
    assert index.in_place
    assert answers(reverse_geocode(logins, index)) == want


@pytest.mark.parametrize("per_row, levels", [(10_000, (8,)), (16, (8,)), (16, (16, 4)), (16, ()), (16, None)])
def test_large_table(world, monkeypatch, per_row, levels):
    geo, logins, want = world
    monkeypatch.setattr(geo_module, "POINTS_PER_ROW", per_row)
    index = PointIndex.build(geo, CELL, levels=levels, broadcast_bytes=0, stored=True)
    assert not index.in_place
    assert answers(reverse_geocode(logins, index, share=0.05, min_rows=0)) == want


def test_missing_and_broken_coordinates(spark, world):
    geo, _, _ = world
    logins = spark.createDataFrame([(1, None, "1"), (2, "x", "1"), (3, "", "")], "n int, lng string, lat string")
    for limit in (None, 0):
        index = PointIndex.build(geo, CELL, broadcast_bytes=limit)
        assert answers(reverse_geocode(logins, index)) == {n: C.NO_INFO for n in (1, 2, 3)}


def test_empty_place_texts_are_no_info(world):
    geo, logins, _ = world
    row = reverse_geocode(logins, PointIndex.build(geo, CELL)).filter("province <> '无信息'").first()
    assert (row["district"], row["address"]) == (C.NO_INFO, C.NO_INFO) and row["city"].startswith("c")


def test_no_cross_join(world):
    geo, logins, _ = world
    for limit in (None, 0):
        plan = reverse_geocode(logins, PointIndex.build(geo, CELL, broadcast_bytes=limit))._jdf.queryExecution()
        text_ = plan.executedPlan().toString()
        assert "CartesianProduct" not in text_ and "BroadcastNestedLoopJoin" not in text_


def test_a_pile_in_one_cell_is_refined_until_its_cells_are_small(spark):
    geo = spark.range(20_000).select(
        F.col("id").alias("geo_id"), (F.col("id") % 200).alias("lng_e6"), F.expr("id div 200").alias("lat_e6"),
        *[F.lit("x").alias(c) for c in ("province", "city", "district", "address")],
    )
    index = PointIndex.build(geo, 1_000_000, broadcast_bytes=0, stored=True)
    assert index.grids[0].spread == 1 and index.grids[-1].cell == 1_000_000
    logins = spark.createDataFrame([("0.000101", "0.000050"), ("0.5", "0.5")], "lng string, lat string")
    found = nearest_point(logins.select((F.col("lng").cast("decimal(12,6)") * 1_000_000).cast("bigint").alias("_lng"),
                                        (F.col("lat").cast("decimal(12,6)") * 1_000_000).cast("bigint").alias("_lat")), index)
    assert {r["_lng"]: r["_best"]["geo_id"] for r in found.collect()} == {101: 50 * 200 + 101, 500_000: 19_999}
