import json
import re

from pyspark.sql import functions as F

from skylattice.operators import sinks, spatial
from skylattice.sources import terrain


def test_quarantine_and_reload(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "id long, k string")
    path = str(tmp_path / "t")
    for _ in range(2):
        sinks.append(df, path, {"id": F.col("id").isNotNull(), "key": F.length("k") > 0})
    assert spark.read.parquet(path).count() == 2
    assert sorted(r["reason"] for r in spark.read.parquet(path + "_quarantine").collect()) == ["id", "id", "key", "key"]
    sinks.reload(df, path)
    assert spark.read.parquet(path).count() == 3


def test_state(spark):
    state = spark.createDataFrame([], "name string, value long, checked_at timestamp")
    now = F.lit("2024-01-01 00:00:00")
    assert sinks.get_state(state, "seq") == -1
    state = sinks.put_state(sinks.put_state(state, "seq", 5, now), "seq", 6, now)
    assert sinks.get_state(state, "seq") == 6 and state.count() == 1
    none = spark.createDataFrame([], "name string, wkt string, min_lon double, min_lat double, max_lon double, max_lat double, installed_at timestamp")
    got = sinks.register_region(sinks.register_region(none, "a", "w", (0, 0, 1, 1), now), "a", "w2", (0, 0, 2, 2), now).collect()
    assert [(r["name"], r["wkt"], r["max_lon"]) for r in got] == [("a", "w2", 2.0)]


def test_reports(spark):
    df = spark.createDataFrame([(i, "<b>") for i in range(5)], "i int, s string")
    assert len(json.loads(sinks.report_json(df))) == 5
    page = sinks.report_html(df, "T & x", most=3)
    assert page.count("<tr>") == 4 and "2 rows aren't shown" in page and "&lt;b&gt;" in page and "T &amp; x" in page


def test_grids(spark, tmp_path):
    head = "ncols 3\nnrows 2\nxllcorner 10\nyllcorner 50\ncellsize 0.5\nNODATA_value -9999\n"
    (tmp_path / "N50.asc").write_text(head + "1 2 3\n4 -9999 6\n")
    (tmp_path / "N60.asc").write_text(head + "1 2 3\n4 5 6\n")
    wanted = spark.createDataFrame([("N50",), ("N60",), ("gone",)], "tile string")
    done = spark.createDataFrame([("N60",)], "tile string")
    tiles = terrain.load(spark, str(tmp_path), wanted, done, side=2)
    assert sorted(r["tile_id"] for r in tiles.collect()) == ["N50/00000/00000", "N50/00000/00002"]
    ps = spark.createDataFrame([(1, 10.1, 50.9), (2, 11.4, 50.1), (3, 10.6, 50.1), (4, 10.6, 50.6)], "id long, lon double, lat double")
    assert {r["point_id"]: r["value"] for r in spatial.raster_values(ps, tiles, 1.0).collect()} == {1: 1.0, 2: 6.0, 4: 2.0}


def test_statistics_reach_the_planner(spark):
    name = "analyzed_table"
    spark.sql(f"drop table if exists {name}")
    spark.range(50).withColumnRenamed("id", "k").write.saveAsTable(name)
    sinks.analyze(spark, name, ["k"])
    said = {r["col_name"]: r["data_type"] for r in spark.sql(f"describe extended {name}").collect()}
    assert "50 rows" in said["Statistics"]
    assert {r["info_name"]: r["info_value"] for r in spark.sql(f"describe extended {name} k").collect()}["max"] == "49"
    spark.sql(f"drop table {name}")


def test_box_of_cells_skips_files(spark, tmp_path):
    rows = spark.range(4000).selectExpr("id", "cast(id % 200 as double) x", "cast(floor(id / 200) as double) y")
    sinks.write_by_cell(rows, str(tmp_path / "t"), 10.0, files=10)
    got = sinks.read_box(spark, str(tmp_path / "t"), 10.0, (0.0, 0.0, 9.5, 9.5))
    assert got.columns == ["id", "x", "y"] and got.count() == 100
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(cx", got._jdf.queryExecution().toString())
