"""Boxes over records laid out along the curve."""

import random

import pytest
from pyspark.sql import functions as F

from stackroom.operators import places, search
from workload.views import records

BOXES = [(10, -20, -50, 120), (-10, 150, -60, -160), (90, -180, -90, 180), (0, 0, 0, 0), (-41.2, 174.7, -41.4, 174.9), (90, 180, 89.999, 180), (5, 179.99, -5, -179.99)]


@pytest.fixture(scope="module")
def laid_out(spark, tmp_path_factory):
    draw = random.Random(2)
    rows = [(i, draw.uniform(-90, 90), draw.uniform(-180, 180)) for i in range(3000)]
    rows += [(i + 3000, lat, lon) for i, (lat, lon) in enumerate([(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0), (None, 1.0), (1.0, None), (float("nan"), 0.0), (0.0, float("nan")), (0.0, 200.0), (0.0, -200.0), (95.0, 0.0), (-41.3, 174.8)])]
    df = spark.createDataFrame(rows, "id long, lat double, lon double")
    path = str(tmp_path_factory.mktemp("places")) + "/t"
    places.write_by_place(df, path, files=20)
    return df, spark.read.parquet(path)


@pytest.mark.parametrize("box", BOXES)
def test_box_equals_scan(laid_out, box):
    plain, table = laid_out
    found = places.bbox_of_layout(table, *box)
    assert found.columns == plain.columns
    assert sorted(r["id"] for r in found.collect()) == sorted(r["id"] for r in search.geo_bbox(plain, *box).collect())


def test_cells_interleave(spark):
    row = spark.range(1).select(places.geo_cell(F.lit(-90.0), F.lit(-180.0)), places.geo_cell(F.lit(89.9999), F.lit(-180.0)), places.geo_cell(F.lit(-90.0), F.lit(179.9999))).first()
    assert tuple(row) == (0, 0x55555555, 0xAAAAAAAA)


def test_ranges_are_pushed_and_skip_files(spark, laid_out):
    _, table = laid_out
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    found = places.bbox_of_layout(table, -41.2, 174.7, -41.4, 174.9)
    plan = found._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(geo_cell" in plan[plan.index("PushedFilters") :]
    assert len(places.box_ranges(-41.2, 174.7, -41.4, 174.9)) <= places.RANGES
    # Few of the 20 files hold a cell of the box.
    ranges = places.box_ranges(20, 0, 0, 20)
    spans = table.groupBy(F.input_file_name()).agg(F.min("geo_cell").alias("a"), F.max("geo_cell").alias("b")).collect()
    assert 0 < sum(any(s["a"] is not None and s["a"] <= high and low <= s["b"] for low, high in ranges) for s in spans) <= 4


def test_box_of_records(spark, sf, tmp_path):
    rows = records(spark, sf)
    places.write_by_place(rows, str(tmp_path / "t"))
    found = places.bbox_of_layout(spark.read.parquet(str(tmp_path / "t")), -10, 150, -60, -160)
    assert sorted(r["id"] for r in found.collect()) == sorted(r["id"] for r in search.geo_bbox(rows, -10, 150, -60, -160).collect())
