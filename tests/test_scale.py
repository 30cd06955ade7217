"""Plans that stay small: no geometry through the driver, no pile of rows in one task."""

from pathlib import Path

from pyspark.sql import functions as F

from gevel import sinks
from gevel.catalog import documents as CD
from gevel.catalog import spatial as CS
from gevel.functions import geometry as G
from gevel.operators import points as PT
from gevel.operators import regions as RN
from gevel.operators import spatial as S
from gevel.operators import webservice as W


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def boxes(spark, n=40):
    df = spark.range(n).select(F.col("id").alias("fid"), *[(F.col("id") * 3 + k).cast("double").alias(c) for c, k in zip(G.BOX, (0, 0, 4, 4))])
    return df.withColumn("rings", G.box_rings(*G.BOX))


def test_overlaps_are_given_back_without_a_broadcast(spark):
    """F1, F2."""
    df = boxes(spark)
    assert "BroadcastExchange" not in plan(S.overlap_area(df, "fid"))
    assert "BroadcastExchange" not in plan(S.overlap_area(df, "fid", crowd=1))


def test_pairs_of_overlaps_are_not_shuffled(spark, monkeypatch):
    """of the shapes only copies in their pieces are sent; a full piece is shared among tasks, with the same areas."""
    df = boxes(spark, 200)
    for crowd in (256, 3):
        steps = plan(S.overlap_area(df, "fid", crowd=crowd))
        steps = steps[steps.index("ObjectHashAggregate"):]
        assert "Exchange" not in steps[: steps.index("SortMergeJoin")]
        assert steps.count("Exchange") == 2
    want = sorted(map(tuple, S.overlap_area(df, "fid", crowd=3).collect()))
    assert len(want) == 200
    monkeypatch.setattr(S, "PIECE_ROWS", 2)
    assert sorted(map(tuple, S.overlap_area(df, "fid", crowd=3).collect())) == want
    turned = G.with_bbox(df.select("fid", F.transform("rings", lambda r: F.transform(r, lambda p: G.point((p.x + p.y) / 2, (p.x - p.y) / 2))).alias("rings")))
    few = sorted((f, round(a, 6)) for f, a in S.overlap_area(turned, "fid", crowd=3).collect())
    monkeypatch.setattr(S, "PIECE_ROWS", 2048)
    assert few == sorted((f, round(a, 6)) for f, a in S.overlap_area(turned, "fid").collect())


def test_cells_of_regions_are_joined_without_a_broadcast(spark):
    """F6."""
    df = boxes(spark)
    assert "BroadcastExchange" not in plan(RN.assign_region(df, df.select(F.col("fid").alias("k"), "rings"), "k", "fid"))


def test_adjacent_and_layers_without_a_broadcast(spark):
    """F9, F12, F13."""
    df = boxes(spark)
    assert "BroadcastExchange" not in plan(S.adjacent_count(df, "fid"))
    layer = spark.range(9).select(F.col("id").alias("identificatie"))
    assert "BroadcastExchange" not in plan(W.lod_layer(layer, layer.withColumn("a", F.lit(1)), ["a"]))


def test_large_tiles_are_written_by_several_tasks(spark, tmp_path):
    """F3."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    docs = spark.range(20000, numPartitions=8).select(F.when(F.col("id") < 19990, "a").otherwise("b").alias("tile_id"), F.sha2(F.col("id").cast("string"), 256).alias("doc"))
    try:
        spark.conf.set(key, "100k")
        sinks.write_features(docs, str(tmp_path / "t"))
    finally:
        spark.conf.set(key, before)
    assert len(list(Path(tmp_path / "t" / "tile_id=a").glob("*.txt"))) > 1
    assert spark.read.text(str(tmp_path / "t")).select("value", "tile_id").distinct().count() == 20000


def test_points_under_copies_and_repeated_ids(spark):
    """one join for footprints alike; an id with two footprints has the points of both."""
    foot = spark.createDataFrame([(1, 0.0, 0.0, 2.0, 2.0), (2, 0.0, 0.0, 2.0, 2.0), (3, 0.0, 0.0, 2.0, 2.0), (3, 1.0, 1.0, 3.0, 3.0), (4, 8.0, 8.0, 9.0, 9.0), (5, None, None, None, None)], "fid long, x0 double, y0 double, x1 double, y1 double")
    foot = foot.withColumn("rings", F.when(F.col("x0").isNotNull(), G.box_rings(*G.BOX)))
    pts = spark.createDataFrame([(0.5, 0.5, 7), (1.5, 1.5, 7), (2.5, 2.5, 8)], "x double, y double, tile long")
    shapes, _ = PT.alike(foot.where("fid <= 2"), "fid")
    assert shapes.count() == 1
    got = {tuple(r) for r in PT.points_and_tiles(pts, foot, "fid", "tile").select("fid", "n_points", "n_tiles").collect()}
    assert got == {(1, 2, 1), (2, 2, 1), (3, 4, 2)}


def test_slanted_shapes_that_miss_their_copies(spark):
    """rings are on the own row only."""
    diamond = F.array(F.array(*[G.point(F.col("x") + a, F.lit(b)) for a, b in ((0.0, 2.0), (2.0, 0.0), (4.0, 2.0), (2.0, 4.0), (0.0, 2.0))]))
    df = spark.createDataFrame([(1, 63.0), (2, 63.0), (3, 65.0), (4, 500.0)], "fid long, x double").select("fid", diamond.alias("rings"))
    for crowd in (256, 1):
        got = {r.fid: round(r.b3_bag_bag_overlap, 6) for r in S.overlap_area(G.with_bbox(df), "fid", min_area=0.5, crowd=crowd).collect()}
        assert got == {1: 8.0, 2: 8.0, 3: 2.0}


def test_costly_rows_are_dealt_out(spark, tmp_path):
    """F8, F14."""
    spark.range(9).selectExpr("id AS p_partkey", "1 AS p_size").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    for df in (CS.houses(spark, str(tmp_path)), CD.row_houses(spark, str(tmp_path))):
        assert df.rdd.getNumPartitions() > 1
