"""Writers and table helpers."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gevel.functions import geometry as G
from gevel.functions.rows import spread
from gevel.operators.quality import assert_references, profile
from gevel.operators.tiling import cluster_by_location
from gevel.session import cut_lineage


#: write option for folders of very many files: each task puts its own in place, else the driver moves one after the other
TASKS_COMMIT = ("mapreduce.fileoutputcommitter.algorithm.version", "2")


def replace_table(df: DataFrame, name: str) -> DataFrame:
    """Replaces a table and returns its profile."""
    df.write.mode("overwrite").saveAsTable(name)
    return profile(df.sparkSession.table(name))


def new_rows(df: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows whose key the target lacks; of several with one key the smallest in column order."""
    rest = [c for c in df.columns if c != key]
    once = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_least")).select(key, "_least.*") if rest else df.distinct()
    return assert_references(once, target, key).select(*df.columns)


def insert_ignore(df: DataFrame, table: str, key: str) -> None:
    """Appends new keys; rows already there stay as they are."""
    fresh = new_rows(df, df.sparkSession.table(table), key)
    fresh.write.mode("append").saveAsTable(table)


def append_rows(df: DataFrame, table: str) -> None:
    df.write.mode("append").saveAsTable(table)


def write_csv(df: DataFrame, path: str, quote_text: bool = False) -> None:
    """CSV with a header; arrays are written as bracket lists.

    With ``quote_text`` the header and every value that is not a number or a flag are quoted, missing text as an
    empty pair of quotes; numbers stand as they are. Each file begins with the header.
    """
    flat = df.select(
        *[
            F.concat(F.lit("["), F.array_join(F.col(c).cast("array<string>"), ", "), F.lit("]")).alias(c)
            if t.startswith("array")
            else F.col(c)
            for c, t in df.dtypes
        ]
    )
    if not quote_text:
        flat.write.mode("overwrite").csv(path, header=True)
        return

    def quoted(text: Column) -> Column:
        return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))

    plain = (T.NumericType, T.BooleanType)
    cells = [
        F.coalesce(F.col(f.name).cast("string"), F.lit("")) if isinstance(f.dataType, plain) else quoted(F.coalesce(F.col(f.name).cast("string"), F.lit("")))
        for f in flat.schema.fields
    ]
    names = ",".join('"' + c.replace('"', '""') + '"' for c in flat.columns)

    def with_header(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([names])], ["value"])
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string())], ["value"])

    flat.select(F.concat_ws(",", *cells).alias("value")).mapInArrow(with_header, "value string").write.mode("overwrite").text(path)


def _by_tile(df: DataFrame, tile: str, files: int) -> DataFrame:
    """A task for each tile, or ``files`` of them, so that a tile does not get a file from every task."""
    return df.repartition(tile, *([F.pmod(F.xxhash64(*df.columns), F.lit(files))] if files > 1 else []))


def write_features(docs: DataFrame, path: str, tile: str = "tile_id", doc: str = "doc", files: int | None = None) -> None:
    """Documents as JSON lines below their tile; ``read_features`` reads them.

    A tile has up to ``files`` files. Without that number its size decides: a small tile is one file, a
    large one is divided among tasks, since a task sorts and writes all it gets.
    """
    rows = docs.select(tile, doc)
    dealt = rows.hint("rebalance", tile) if files is None else _by_tile(rows, tile, files)
    dealt.write.mode("overwrite").partitionBy(tile).text(path)


def mounted(spark: SparkSession, path: str) -> str | None:
    """The path as the operating system knows it, if it lies on a file system that tasks have mounted."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        scheme, rest = str(spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file").partition(":")[0], path
    elif scheme == "file":
        rest = unquote(rest)
    return re.sub("^/+", "/", rest) if scheme == "file" and rest.startswith("/") else None


def _folder(key: str, value: str | None) -> str:
    """The name that Spark gives a partition's folder."""
    if not value:
        return f"{key}=__HIVE_DEFAULT_PARTITION__"
    return f"{key}=" + re.sub(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", value)


def write_texts(df: DataFrame, path: str, keys: Sequence[str], text: str) -> None:
    """A text file for each value of ``keys``, for very many small files; names are those of ``partitionBy``, values are text.

    All tasks write. On a mounted file system they do so without Hadoop's client, which starts programs to set the
    rights of each file, and the last key names the file, ``tile_id=7.txt``, as a folder for each file takes long to list;
    a file appears under its name when it is whole, and a task that is repeated replaces it.
    """
    spark = df.sparkSession
    rows = spread(df.select(*keys, text), *keys)
    root = mounted(spark, path)
    if root is None:
        rows.write.option(*TASKS_COMMIT).partitionBy(*keys).text(path)
        return

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, here, file, name, run = 0, None, None, "", uuid.uuid4().hex

        def close() -> int:
            if file is None:
                return 0
            file.close()
            os.replace(file.name, name)
            return 1

        for batch in batches:
            lists = [c.to_pylist() for c in batch.columns]
            for *place, line in zip(*lists, strict=True):
                if place != here:
                    made += close()
                    here, name = place, "/".join([root, *(_folder(k, v) for k, v in zip(keys, place, strict=True))]) + ".txt"
                    folder = os.path.dirname(name)
                    os.makedirs(folder, exist_ok=True)
                    file = open(f"{folder}/.{run}", "wb")
                file.write((line or "").encode() + b"\n")
        made += close()
        yield pa.RecordBatch.from_arrays([pa.array([made])], ["files"])

    os.makedirs(root)
    rows.sortWithinPartitions(*keys).mapInArrow(put, "files long").agg(F.sum("files")).collect()


def write_clustered(df: DataFrame, path: str, files: int = 64, cell: float = 50.0, file_rows: int = 1_000_000) -> None:
    """Rows with box columns in Morton order, in about ``files`` files, and the box of each file; ``read_box`` reads them.

    Files hold disjoint ranges of the order and rows are sorted within, so both files and row groups cover small areas.
    A place with very many rows gives several files of at most ``file_rows``. Rows without a box come last.
    """
    data = cluster_by_location(df, files, cell)
    data.write.mode("overwrite").option("maxRecordsPerFile", file_rows).parquet(f"{path}/data")
    back = df.sparkSession.read.schema(df.schema).parquet(f"{path}/data")
    x0, y0, x1, y1 = G.BOX
    boxes = back.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min(x0).alias(x0), F.min(y0).alias(y0), F.max(x1).alias(x1), F.max(y1).alias(y1), F.count("*").alias("n_rows")
    )
    boxes.coalesce(1).write.mode("overwrite").parquet(f"{path}/index")


def changed_partitions(now: DataFrame, before: DataFrame, part: str = "tile_id") -> DataFrame:
    """Partitions in which a file is new, gone or has another hash: ``part`` and ``status`` (changed or gone).

    Both sides are lists of (part, file, hash). A partition is gone when none of its files is left.
    """
    l = now.select(part, "file", F.col("hash").alias("_now"), F.lit(1).alias("_here"))
    r = before.filter(F.col("file").isNotNull()).select(part, "file", F.col("hash").alias("_before"), F.lit(1).alias("_there"))
    both = l.join(r, [part, "file"], "full")
    other = F.col("_here").isNull() | F.col("_there").isNull() | ~F.col("_now").eqNullSafe(F.col("_before"))
    found = both.groupBy(part).agg(F.max(other.cast("int")).alias("_other"), F.count("_here").alias("_left"))
    return found.filter("_other = 1").select(part, F.when(F.col("_left") == 0, "gone").otherwise("changed").alias("status"))


def build_changed(now: DataFrame, build: Callable[[DataFrame], DataFrame], path: str, part: str = "tile_id") -> DataFrame:
    """Rebuilds only the partitions whose files changed since the last run, and returns them with their status.

    ``now`` lists (part, file, hash) and perhaps more columns; ``build`` makes the rows of whole partitions, with the column
    ``part``, from the rows of ``now`` that belong to them. Partitions are replaced, never added to, so a run that is
    repeated changes nothing. The list of files is written after the data: a run that ends between the two is done again.
    The data of partitions that are gone stay until they are deleted; they are reported once.
    """
    spark = now.sparkSession
    listed = now.select(part, "file", "hash")
    try:
        before = spark.read.schema(listed.schema).parquet(f"{path}/files")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        before = listed.limit(0)
    touched = cut_lineage(changed_partitions(listed, before, part))
    if touched.isEmpty():
        return touched
    mine = now.join(touched.filter("status = 'changed'").select(part), part, "left_semi")

    def replace(df: DataFrame, to: str) -> None:
        df.repartition(part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(to)

    replace(build(mine), f"{path}/data")
    none = touched.filter("status = 'gone'").select(part, F.lit(None).cast("string").alias("file"), F.lit(None).cast("string").alias("hash"))
    replace(mine.select(part, "file", "hash").unionByName(none), f"{path}/files")
    return touched


def write_metadata_json(df: DataFrame, path: str) -> None:
    """A single document; ``df`` has exactly one row."""
    df.coalesce(1).write.mode("overwrite").text(path)


def write_tiles_gz(df: DataFrame, path: str, fmt: str = "json", tile: str = "tile_id", file_rows: int = 1_000_000, files: int = 1) -> None:
    """Gzipped files per tile; a tile gets several with over ``file_rows`` rows, or where ``files`` tasks write it."""
    writer = _by_tile(df, tile, files).write.mode("overwrite").partitionBy(tile)
    writer.option("compression", "gzip").option("maxRecordsPerFile", file_rows).format(fmt).save(path)


def union_layers(
    spark: SparkSession, tiles: DataFrame, layers: dict[str, str], fmt: str = "parquet", tile: str = "tile_id", schemas: dict | None = None,
) -> tuple[DataFrame, DataFrame]:
    """All tiles of every layer as one frame, and the (tile, layer) pairs without data.

    ``layers`` maps a layer name to its folder, partitioned by tile; ``schemas`` maps it to its schema,
    without which text formats are read twice.
    """

    def load(name: str, path: str) -> DataFrame:
        reader = spark.read.option("mergeSchema", "true").format(fmt)
        reader = reader.schema(schemas[name]) if schemas else reader
        return reader.load(path).withColumn("layer", F.lit(name)).withColumn(tile, F.col(tile).cast("string"))

    frames = [load(name, path) for name, path in layers.items()]
    every = frames[0]
    for f in frames[1:]:
        every = every.unionByName(f, allowMissingColumns=True)
    names = F.array(*[F.lit(n) for n in layers])
    wanted = tiles.select(tile).withColumn("layer", F.explode(names))
    missing = wanted.join(every.select(tile, "layer").distinct(), [tile, "layer"], "left_anti")
    return every, missing


# --- catalog ----------------------------------------------------------------------------


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def comment_table(spark: SparkSession, name: str, text: str) -> None:
    quoted = text.replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {name} IS '{quoted}'")


def create_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def drop_view(spark: SparkSession, name: str) -> None:
    spark.catalog.dropTempView(name)


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Column order of a declared table; extra columns are dropped."""
    return df.select(*cols)
