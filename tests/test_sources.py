"""Readers, writers and the incremental cube."""

import gzip
import json

from pyspark.sql import functions as F

from gridloom.sources import readers, writers
from gridloom.streaming import incremental


def test_catalog_ledger_words_and_scenes(spark, tmp_path):
    feature = {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[1.0, 2.0], [3.0, 2.0], [3.0, 5.0], [1.0, 2.0]]]}, "properties": {"filename": "a.nc", "directory": "d", "percent_valid_pix": 40.0, "data_epsg": 3413}}
    (tmp_path / "c.json").write_text(json.dumps({"type": "FeatureCollection", "features": [feature, feature]}, indent=1))
    r = readers.catalog(spark, str(tmp_path / "c.json")).first()
    assert (r["url"], r["x0"], r["y1"], r["data_epsg"]) == ("d/a.nc", 1.0, 5.0, 3413)
    (tmp_path / "l.json").write_text(json.dumps({"empty": ["a", "b"], "duplicate": ["c"]}))
    assert sorted(map(tuple, readers.ledger(spark, str(tmp_path / "l.json")).collect())) == [("duplicate", "c"), ("empty", "a"), ("empty", "b")]
    (tmp_path / "w.txt").write_text("a b\n c\n\n")
    assert sorted(r[0] for r in readers.words(spark, str(tmp_path / "w.txt")).collect()) == ["a", "b", "c"]
    with gzip.open(tmp_path / "s.csv.gz", "wt") as f:
        f.write("id,cloud\nx,10\n")
    assert readers.scenes(spark, str(tmp_path / "s.csv.gz")).first()["cloud"] == "10"
    assert spark.range(1).select(readers.joined_arrays(F.lit("[1,2][3]"))).first()[0] == "[1,2,3]"


def test_writers(spark, tmp_path):
    cube = spark.createDataFrame([("t1", i % 3, i, float(i)) for i in range(12)], "tile string, x int, y int, v double")
    writers.append_cube(cube, str(tmp_path / "cube"))
    writers.append_cube(cube, str(tmp_path / "cube"))
    assert spark.read.parquet(str(tmp_path / "cube")).count() == 24
    writers.write_packed(cube, {"v": "ushort"}, str(tmp_path / "packed"), ("tile",))
    assert dict(spark.read.parquet(str(tmp_path / "packed")).dtypes)["v"] == "int"
    writers.write_catalog(cube, str(tmp_path / "cat"), 5)
    assert len(list((tmp_path / "cat").glob("*.gz"))) >= 3
    years = spark.createDataFrame([("A", 2000, 1.0), ("A", 2001, 2.0)], "region string, year int, v double")
    writers.write_years(years, str(tmp_path / "mosaic"))
    writers.write_years(years.where("year = 2001").withColumn("v", F.lit(9.0)), str(tmp_path / "mosaic"))
    assert sorted(r["v"] for r in spark.read.parquet(str(tmp_path / "mosaic")).collect()) == [1.0, 9.0]
    writers.write_text(cube.select(F.col("tile")), "tile", str(tmp_path / "text"))
    assert readers.exists(spark, str(tmp_path / "text")) and not readers.exists(spark, str(tmp_path / "none"))


def test_incremental_cube_equals_batch(spark, tmp_path):
    schema = "url string, v double"
    a = spark.createDataFrame([("a", 1.0), ("b", 2.0)], schema)
    b = spark.createDataFrame([("b", 2.0), ("c", 3.0)], schema)
    paths = [str(tmp_path / x) for x in ("in", "cube", "check")]
    a.write.parquet(paths[0])
    assert incremental.update_cube(spark, *paths, schema, "url").count() == 2
    b.write.mode("append").parquet(paths[0])
    got = incremental.update_cube(spark, *paths, schema, "url")
    assert sorted(r["url"] for r in got.collect()) == ["a", "b", "c"]


def test_late_reprocessing_and_windows(spark, tmp_path):
    history = spark.createDataFrame([("p", 1, "old"), ("p", 2, "new")], "id string, proc int, url string")
    assert [r["url"] for r in incremental.current_layers(history, ["id"], ["proc"]).collect()] == ["new"]
    spark.sql("select timestamp'2024-01-01 00:01:00' ts, 1.0 v, 'a' k union all select timestamp'2024-01-01 00:12:00', 2.0, 'a'").write.parquet(str(tmp_path / "ev"))
    stream = spark.readStream.schema("ts timestamp, v double, k string").parquet(str(tmp_path / "ev"))
    q = incremental.windowed(stream, "ts", "1 minute", "5 minutes", "k", value="v").writeStream.outputMode("complete").format("memory").queryName("win").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("win").count() == 2
