"""Clustered files and builds of changed partitions."""

from pyspark.sql import functions as F

from gevel import sinks
from gevel.sources import files as SF

BOX = "fid long, x0 double, y0 double, x1 double, y1 double"


def test_a_box_opens_few_files(spark, tmp_path):
    path = str(tmp_path / "c")
    rows = [(100 * i + j, 20.0 * i, 20.0 * j, 20.0 * i + 15, 20.0 * j + 15) for i in range(60) for j in range(60)]
    df = spark.createDataFrame([*rows, (-1, None, None, None, None)], BOX).repartition(7)
    sinks.write_clustered(df, path, files=32, cell=10.0)
    assert spark.read.parquet(f"{path}/data").count() == len(rows) + 1
    view = (100.0, 100.0, 180.0, 180.0)
    got = SF.read_box(spark, path, *view)
    assert {r["fid"] for r in got.collect()} == {r[0] for r in rows if r[1] <= 180 and r[3] >= 100 and r[2] <= 180 and r[4] >= 100}
    assert len(SF.box_files(spark, path, *view)) <= 6 < 32 <= spark.read.parquet(f"{path}/index").count() + 1
    assert {r[0].split("/")[-1] for r in got.select(F.input_file_name()).distinct().collect()} <= {f.split("/")[-1] for f in SF.box_files(spark, path, *view)}
    assert SF.read_box(spark, path, 9e6, 9e6, 9e6, 9e6).collect() == []


def test_only_changed_partitions_are_rebuilt(spark, tmp_path):
    path, built = str(tmp_path / "b"), []

    def frame(*rows):
        return spark.createDataFrame(list(rows), "tile_id string, file string, hash string, n int")

    def build(rows):
        built.append({r["tile_id"] for r in rows.select("tile_id").collect()})
        return rows.groupBy("tile_id").agg(F.sum("n").alias("n"))

    def run(*rows):
        return {tuple(r) for r in sinks.build_changed(frame(*rows), build, path).collect()}, {r["tile_id"]: r["n"] for r in spark.read.parquet(f"{path}/data").collect()}

    a, b, c = ("t1", "a", "h1", 1), ("t1", "b", "h2", 2), ("t2", "c", None, 4)
    assert run(a, b, c) == ({("t1", "changed"), ("t2", "changed")}, {"t1": 3, "t2": 4})
    assert run(a, b, c) == (set(), {"t1": 3, "t2": 4}) and len(built) == 1  # nothing is written
    assert run(a, ("t1", "b", "h3", 20), c) == ({("t1", "changed")}, {"t1": 21, "t2": 4}) and built[-1] == {"t1"}
    assert run(a, c)[1] == {"t1": 1, "t2": 4}  # a file less
    assert run(a)[0] == {("t2", "gone")} and run(a)[0] == set()
    assert run(a, c, ("t3", "d", "h", 8)) == ({("t2", "changed"), ("t3", "changed")}, {"t1": 1, "t2": 4, "t3": 8})
