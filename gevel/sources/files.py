"""Readers for the other file formats."""

from __future__ import annotations

import gzip
import io
import sys
import zipfile
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gevel.functions import geometry as G
from gevel.functions.text import feature_stem
from gevel.operators.documents import city_objects
from gevel.operators.quality import REPORT_SCHEMA, obj_ids
from gevel.session import cut_lineage

# The archive check travels with its task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUADTREE_SCHEMA = "id string, level int, nr_items long, leaf string, wkt string"
CHUNK = 1 << 20


# --- text parsers -----------------------------------------------------------------------


def parse_geojson(df: DataFrame, doc: str, id: str, links: Sequence[str] = ()) -> DataFrame:
    """Polygons of a collection: lower-cased id, link properties and rings; a row for each part of a multipolygon.

    A feature without a polygon stays, with NULL rings.
    """
    schema = "features array<struct<properties: map<string,string>, geometry: string>>"
    f = df.select(F.explode(F.from_json(doc, schema)["features"]).alias("_f"))
    props = F.col("_f.properties")
    return f.select(
        F.lower(props[id]).alias("tile_id"), *[props[k].alias(k) for k in links], F.explode_outer(G.parts_from_geojson("_f.geometry")).alias("rings")
    )


def parse_checksums(lines: DataFrame, line: str = "value") -> DataFrame:
    """``<hash> <file>`` per line; a line with a file only has no hash."""
    parts = F.split(F.trim(line), r"\s+")
    two = F.size(parts) >= 2
    return lines.filter(F.length(F.trim(line)) > 0).select(
        F.when(two, parts[1]).otherwise(parts[0]).alias("file"), F.when(two, parts[0]).otherwise("").alias("hash")
    )


def parse_quadtree(lines: DataFrame, line: str = "value") -> DataFrame:
    """Tab-separated quadtree rows, header dropped."""
    row = F.from_csv(F.col(line), QUADTREE_SCHEMA, {"sep": "\t"})
    return lines.filter(~F.col(line).startswith("id\tlevel")).select(row.alias("_r")).select("_r.*")


def parse_reports(df: DataFrame, doc: str = "doc") -> DataFrame:
    """One row per feature of a validation report; the other columns repeat."""
    rest = [c for c in df.columns if c != doc]
    f = df.select(*rest, F.explode(F.from_json(doc, REPORT_SCHEMA)["features"]).alias("_f"))
    return f.select(*rest, "_f.id", "_f.validity", "_f.primitives")


def parse_event_logs(df: DataFrame, doc: str = "doc", step: str | None = None) -> DataFrame:
    """Messages of a run's event list, of one step where it is named."""
    schema = "event_list array<struct<step_key:string, user_message:string>>"
    e = df.select(F.explode(F.from_json(doc, schema)["event_list"]).alias("_e")).select("_e.*")
    e = e if step is None else e.filter(F.col("step_key") == step)
    return e.select(F.col("user_message").alias("value"))


# --- readers ----------------------------------------------------------------------------


def _documents(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    r = spark.read.option("recursiveFileLookup", "true")
    r = r.option("pathGlobFilter", glob) if glob else r
    return r.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("doc"))


MARK = "\ufeff"  # at the beginning of a file; Spark's reader of lines leaves it out


def _lines(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """Every line of the files with its place and the length of its file; a large file is read by several tasks."""
    r = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).option("lineSep", "\n")
    return r.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("n"), F.col("value").alias("line"),
    )


def _joined(lines: DataFrame) -> DataFrame:
    """Whole files from their lines, with the mark at their beginning and the line feed at their end where there was one."""
    whole = lines.groupBy("path").agg(F.first("size").alias("_size"), F.array_sort(F.collect_list(F.struct("start", "n", "line")))["line"].alias("_lines"))
    text = F.array_join("_lines", "\n")
    left = F.col("_size") - F.octet_length(text)
    return whole.select("path", F.concat(F.when(left >= 3, MARK).otherwise(""), text, F.when(left % 3 == 1, "\n").otherwise("")).alias("doc"))


def read_geojson(spark: SparkSession, path: str, id: str, links: Sequence[str] = ()) -> DataFrame:
    return parse_geojson(_documents(spark, path), "doc", id, links)


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    return parse_checksums(spark.read.text(path))


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Building documents of single files, indented or not, and of files with one document per line.

    The id is that of the document's building, its smallest object name; a document without objects is
    named after its file.
    """
    files = _lines(spark, path, "*.{city.jsonl,txt}")
    # a document over several lines has lines that are no objects; only such a file is put together in memory
    stands = F.col("line").rlike(r"^\s*\{.*\}\s*$") | (F.trim("line") == "")
    sums = files.groupBy("path").agg(F.max(~stands).alias("_broken"), F.sum(F.octet_length("line") + 1).alias("_length"), F.first("size").alias("_size"))
    broken = cut_lineage(sums.filter("_broken OR _length < _size").select("path"))
    lines = files.filter(F.trim("line") != "").select("path", F.col("line").alias("doc"))
    if broken.isEmpty():
        docs = lines
    else:
        docs = lines.join(broken, "path", "left_anti").unionByName(_joined(files.join(broken, "path", "left_semi")))
    names = F.json_object_keys(F.get_json_object("doc", "$.CityObjects"))
    return docs.withColumn("id", F.coalesce(F.array_min(names), feature_stem("path")))


def read_file_list(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Paths and lengths of all files below a folder; contents are not read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    r = r.option("pathGlobFilter", glob) if glob else r
    return r.load(path).select("path", "length")


def read_file_hashes(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Path and SHA-256 of all files below a folder."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    r = r.option("pathGlobFilter", glob) if glob else r
    # a scan of very many small files is laid out as a task for every few of them
    tasks = 8 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return r.load(path).select("path", F.sha2("content", 256).alias("sha256")).coalesce(tasks)


# Directory layouts of the building documents.
LAYOUTS = {
    "objects": r"(\d+/\d+/\d+)/objects/([^/]+)/reconstruct/([^/]+)\.city\.jsonl$",
    "tiles": r"(\d+/\d+/\d+)/([^/]+)\.city\.jsonl$",
}


def index_features(files: DataFrame, layout: str, path: str = "path") -> DataFrame:
    """Building id, tile and path of each document that fits the layout."""
    pattern = LAYOUTS[layout]
    out = files.select(
        F.regexp_extract(path, pattern, 2).alias("id"), F.regexp_extract(path, pattern, 1).alias("tile_id"), path
    ).filter("id <> ''")
    if layout == "objects":
        out = out.filter(F.regexp_extract(path, pattern, 3) == F.col("id"))
    return out


def feature_file_index(spark: SparkSession, path: str, layout: str) -> DataFrame:
    return index_features(read_file_list(spark, path, "*.city.jsonl"), layout)


def read_cityjson_tile(spark: SparkSession, path: str) -> DataFrame:
    """City objects of whole-tile documents."""
    return city_objects(_documents(spark, path))


def box_files(spark: SparkSession, path: str, x0: float, y0: float, x1: float, y1: float) -> list[str]:
    """Files of ``write_clustered`` whose box meets the given one; their list has a row per file, not per feature."""
    index = spark.read.parquet(f"{path}/index").filter(G.in_bbox(x0, y0, x1, y1))
    return sorted(f"{path}/data/{r['file']}" for r in index.select("file").collect())


def read_box(spark: SparkSession, path: str, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    """Rows of ``write_clustered`` whose box meets the given one. Other files are not opened, nor row groups by their statistics."""
    files = box_files(spark, path, x0, y0, x1, y1)
    if not files:
        return spark.read.parquet(f"{path}/data").limit(0)
    return spark.read.parquet(*files).filter(G.in_bbox(x0, y0, x1, y1))


def read_quadtree(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema=QUADTREE_SCHEMA)


def read_csv_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """CSV with a header; every column of the validation tables is text at first. Quotes within quoted text are doubled."""
    return spark.read.csv(path, header=True, schema=schema, escape='"')


def read_table(spark: SparkSession, name: str, **jdbc: str) -> DataFrame:
    """A catalog table, or a database table when connection options are given."""
    if jdbc:
        return spark.read.format("jdbc").options(dbtable=name, **jdbc).load()
    return spark.table(name)


def read_obj_lines(spark: SparkSession, path: str) -> DataFrame:
    """Object names of OBJ files with tile and level of detail from the file name."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.obj").text(path)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)-LoD(\d{2})-3D\.obj$", 1)
    lod = F.regexp_extract(F.col("_metadata.file_path"), r"-LoD(\d{2})-3D\.obj$", 1)
    return obj_ids(lines.select(F.translate(name, "-", "/").alias("tile_id"), lod.alias("lod"), F.col("value").alias("line")))


def read_point_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("asset string, run_id string, ts timestamp, rows long, data_version string").json(path)


def read_validation_reports(spark: SparkSession, path: str) -> DataFrame:
    return parse_reports(_documents(spark, path))


def read_tool_logs(spark: SparkSession, path: str, events: bool = False, step: str | None = None) -> DataFrame:
    """Log lines, or the messages of (gzipped) event documents."""
    if events:
        return parse_event_logs(_documents(spark, path).drop("path"), step=step)
    return spark.read.text(path)


# --- archives ---------------------------------------------------------------------------


def _members(path: str, content: bytes) -> Iterator[tuple[str, str, bool, int]]:
    """Name, soundness and size of each member, read in chunks."""
    if path.endswith(".gz"):
        size, ok = 0, True
        try:
            with gzip.open(io.BytesIO(content)) as f:
                while block := f.read(CHUNK):
                    size += len(block)
        except (OSError, EOFError, zlib.error):
            ok = False
        yield path, path.rsplit("/", 1)[-1][:-3], ok, size
        return
    try:
        archive = zipfile.ZipFile(io.BytesIO(content))
    except zipfile.BadZipFile:
        yield path, "", False, 0
        return
    with archive:
        for info in archive.infolist():
            ok, size = True, 0
            try:
                with archive.open(info) as f:
                    while block := f.read(CHUNK):
                        size += len(block)
            except (OSError, EOFError, zipfile.BadZipFile, zlib.error, RuntimeError, NotImplementedError):
                ok = False  # RuntimeError: encrypted; NotImplementedError: unknown method
            yield path, info.filename, ok, size


def check_archives(files: DataFrame) -> DataFrame:
    """Integrity of each zip or gzip member. ``files(path, content)``, one archive per row."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [m for p, c in zip(batch["path"], batch["content"]) for m in _members(p, bytes(c))]
            yield pd.DataFrame(rows, columns=["path", "member", "ok", "size"])

    return files.select("path", "content").mapInPandas(check, "path string, member string, ok boolean, size long")


def read_archives(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    r = r.option("pathGlobFilter", glob) if glob else r
    return check_archives(r.load(path))
