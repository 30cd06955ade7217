"""Run log, lineage document and tool logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gevel.functions.quantiles import group_quantiles
from gevel.functions.rows import settle

# Runs whose newest events make up the lineage, in order.
LINEAGE_ASSETS = [
    "bag.extract_bag", "bag.bag_pandactueelbestaand", "top10nl.extract_top10nl", "top10nl.top10nl_gebouw",
    "input.reconstruction_input",
]
# Steps timed in the logs.
STEPS = [
    "ArrangementOptimiser", "ArrangementBuilder", "SegmentRasteriser", "LineRegulariser", "PlaneIntersector",
    "extrude", "LineDetector", "AlphaShaper_ground", "PlaneDetector_ground", "AlphaShaper", "PlaneDetector",
]
SLOW_MS = 600_000
TIMED, MODEL = "[reconstructor t] ", ".city.jsonl"


def latest_runs(log: DataFrame, assets: Sequence[str] | None = None) -> DataFrame:
    """The newest event of each asset as a lineage step."""
    if assets is not None:
        log = log.filter(F.col("asset").isin(*assets))
    newest = log.groupBy("asset").agg(
        F.max_by(F.struct("run_id", "rows", "ts", "data_version"), F.struct("ts", "run_id")).alias("_e")
    )
    return newest.select(
        F.col("asset").alias("name"), F.col("_e.run_id").alias("runId"), F.col("_e.rows").alias("featureCount"),
        F.date_format("_e.ts", "yyyy-MM-dd").alias("dateTime"), F.col("_e.data_version").alias("dataVersion"),
    )


def types_per_date(df: DataFrame, wanted: Sequence[str] | None = None, date: str = "date", kind: str = "featuretype") -> DataFrame:
    """Feature types by day (a trailing ``Z`` is dropped), limited to the wanted ones."""
    day = F.substring(F.regexp_replace(F.col(date).cast("string"), "Z$", ""), 1, 10)
    types = F.array_sort(F.collect_set(kind))
    if wanted is not None:
        types = F.array_intersect(types, F.array(*[F.lit(w) for w in wanted]))
    return df.groupBy(day.alias("day")).agg(types.alias("featuretypes"))


def lineage_metadata(
    log: DataFrame, citation: Mapping[str, str], sources: Sequence[Mapping], software: Sequence[Mapping],
    dated_by: Mapping[str, str] | None = None,
) -> DataFrame:
    """One JSON document: citation, lineage steps, sources and software.

    ``dated_by`` names the asset whose data version dates a source.
    """
    order = F.array_position(F.array(*[F.lit(a) for a in LINEAGE_ASSETS]), F.col("name"))
    step = F.struct("name", "runId", "featureCount", "dateTime", "dataVersion")
    # at most one row per lineage asset reaches this point
    steps = latest_runs(log, LINEAGE_ASSETS).agg(
        F.array_sort(F.collect_list(F.struct(order.alias("_o"), step.alias("s")))).alias("_s")
    ).select(F.col("_s.s").alias("processStep"))
    dates = F.map_from_arrays(F.col("processStep.name"), F.col("processStep.dataVersion"))

    def member(fields: Mapping, *more):
        """Rows of one list may differ in their fields, so each becomes a JSON value."""
        cols = [F.lit(v).alias(k) for k, v in fields.items()]
        return F.parse_json(F.to_json(F.struct(*cols, *more), {"ignoreNullFields": "false"}))

    def source(s: Mapping):
        asset = (dated_by or {}).get(s["name"])
        return member(s, F.try_element_at(dates, F.lit(asset)).alias("date")) if asset else member(s)

    lineage = F.struct(
        "processStep",
        F.array(*[F.struct(source(s).alias("source")) for s in sources]).alias("source"),
        F.array(*[member(s) for s in software]).alias("software"),
    )
    doc = F.struct(
        F.struct(F.struct(*[F.lit(v).alias(k) for k, v in citation.items()]).alias("citation")).alias("identificationInfo"),
        F.struct(lineage.alias("lineage")).alias("dataQualityInfo"),
    )
    return steps.select(F.to_json(doc, {"ignoreNullFields": "false"}).alias("doc"))


# --- tool logs --------------------------------------------------------------------------


def log_timings(lines: DataFrame, line: str = "value") -> DataFrame:
    """Step times of each timing line, the last one where a line names a step twice.

    Lines of another form, with a bad number or with an unknown step are skipped.
    """
    timed = settle(lines, F.col(line).alias("_l")).filter(F.contains("_l", F.lit(TIMED)))
    timed = settle(timed, F.expr(f"substring(_l, locate('{TIMED}', _l) + {len(TIMED)})").alias("_l"))
    found = settle(timed, F.substring_index("_l", " ", 1).alias("_p"), "_l").filter(F.startswith("_p", F.lit("/")) & F.endswith("_p", F.lit(MODEL)) & F.contains("_l", F.lit(" ")))
    name = F.substring_index("_p", "/", -1)
    found = settle(found, F.substring(name, F.lit(1), F.length(name) - len(MODEL)).alias("building_id"), "_p", "_l", F.split("_l", ",").alias("_w")).filter("building_id <> ''")
    # most lines read like the numbers found at the usual places when these are written out again; only the others are searched
    there = [F.substring_index(F.get("_w", F.lit(2 * i + 1)), ")", 1).try_cast("int").alias(step) for i, step in enumerate(STEPS)]
    found = settle(found, "building_id", "_p", "_l", *there)
    again = [x for i, step in enumerate(STEPS) for x in (F.lit(("),(" if i else " ((") + step + ", "), F.col(step).cast("string"))]
    usual = F.coalesce(F.col("_l") == F.concat("_p", *again, F.lit("),)")), F.lit(False))
    found = settle(found, "building_id", "_p", "_l", usual.alias("_usual"), *STEPS)
    rest = F.substring("_l", F.length("_p") + 2, F.length("_l"))
    words = F.when(~F.col("_usual"), F.split(F.translate(rest, "() ", ""), ","))
    found = settle(found, "building_id", "_usual", words.alias("_w"), *[F.when(F.col("_usual"), F.col(s)).alias(s) for s in STEPS])
    # names and numbers take turns
    found = found.filter(F.col("_usual") | (F.size("_w") > 1))
    at = F.sequence(F.lit(0), F.floor(F.size("_w") / 2).cast("int") - 1)
    names = F.when(~F.col("_usual"), F.reverse(F.transform(at, lambda i: F.get("_w", i * 2))))
    times = F.when(~F.col("_usual"), F.reverse(F.transform(at, lambda i: F.get("_w", i * 2 + 1).try_cast("int"))))
    found = settle(found, "building_id", "_usual", names.alias("_k"), times.alias("_v"), *STEPS)
    known = ~F.exists("_v", lambda v: v.isNull()) & (F.size(F.array_except("_k", F.array(*map(F.lit, STEPS)))) == 0)
    last = [F.coalesce(F.col(s), F.get("_v", F.array_position("_k", s).cast("int") - 1)).alias(s) for s in STEPS]
    return found.filter(F.col("_usual") | known).select("building_id", *last)


def unfinished(lines: DataFrame, line: str = "value") -> DataFrame:
    """Buildings with a start line and no finish line."""
    def ids(word: str) -> DataFrame:
        pattern = r"\[reconstructor\] " + word + r": /\S*?([^/\s]+)\.city\.jsonl"
        return settle(lines, F.regexp_extract(line, pattern, 1).alias("building_id")).filter("building_id <> ''")

    return ids("start").distinct().join(ids("finish"), "building_id", "left_anti")


def one_run(times: DataFrame, steps: Sequence[str] = STEPS) -> DataFrame:
    """One whole row of step times per building, the smallest in step order."""
    return times.groupBy("building_id").agg(F.min(F.struct(*steps)).alias("_s")).select("building_id", "_s.*")


def step_statistics(times: DataFrame, steps: Sequence[str] = STEPS) -> DataFrame:
    """Median and mean per step over distinct buildings."""
    long = one_run(times, steps).unpivot("building_id", list(steps), "step", "ms").filter("ms IS NOT NULL")
    counted = long.groupBy("step", "ms").agg(F.count("*").alias("n"))
    medians = group_quantiles(counted, ["step"], "ms", {"median": 0.5}, count="n")
    means = counted.groupBy("step").agg((F.sum(F.col("ms") * F.col("n")) / F.sum("n")).alias("mean"))
    return medians.join(means, "step")


def slow_buildings(times: DataFrame, steps: Sequence[str] = STEPS, limit: float = SLOW_MS) -> DataFrame:
    """Distinct buildings whose steps take longer than ``limit`` together."""
    one = one_run(times, steps)
    total = sum((F.coalesce(F.col(s), F.lit(0)) for s in steps[1:]), F.coalesce(F.col(steps[0]), F.lit(0)))
    return one.withColumn("total", total).filter(F.col("total") > limit)


def method_statistics(df: DataFrame, key: str = "type", value: str = "run_ns") -> DataFrame:
    """Median, mean and standard deviation per method."""
    spread = df.groupBy(key).agg(F.avg(value).alias("avg"), F.stddev_samp(value).alias("sd"))
    return group_quantiles(df, [key], value, {"median": 0.5}).join(spread, key)


def sizes(files: DataFrame, length: str = "length", per: Sequence[str] = ()) -> DataFrame:
    """Total size of files in MB (two digits) and GB."""
    total = F.sum(length)
    return files.groupBy(*per).agg(
        F.count("*").alias("n_files"), F.round(total / 1e6, 2).alias("size_mb"), (total / 1e9).alias("size_gb")
    )
