"""Relational queries: survivors, updates, layers, checks, lineage and features."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gevel import sinks
from gevel.catalog import adapters as A
from gevel.catalog.spatial import REGISTER_SQL, register_rows
from gevel.functions import text as TX
from gevel.functions.quantiles import group_quantiles
from gevel.operators import documents as D
from gevel.operators import features as FE
from gevel.operators import history as H
from gevel.operators import lineage as L
from gevel.operators import model as M
from gevel.operators import quality as Q
from gevel.operators import webservice as W
from gevel.plans import reconstruction as RC
from gevel.session import shared_dir
from gevel.sources import files as SF


def dedupe(spark, sf):
    """One line per order in a fixed order."""
    li = A.table(spark, sf, "lineitem")
    order = [F.col("l_extendedprice").desc(), "l_partkey", "l_suppkey", "l_linenumber"]
    return A.shaped(H.dedupe(li, "l_orderkey", order), "l_orderkey:l l_partkey:l l_suppkey:l l_linenumber:l l_extendedprice:d")


def update_from(spark, sf):
    """Matched rows take the new code, others stay NULL."""
    part = A.table(spark, sf, "part").select("p_partkey", "p_brand")
    li = A.table(spark, sf, "lineitem").filter("l_returnflag = 'R' AND l_discount > 0.07")
    kinds = (
        F.when(F.col("l_linenumber") == 1, "appartement").when(F.col("l_linenumber") == 2, "hoekwoning")
        .when(F.col("l_linenumber") == 3, "vrijstaande woning").otherwise("anders")
    )
    new = li.select(F.col("l_partkey").alias("p_partkey"), FE.building_type(kinds).alias("buildingtype"))
    return A.shaped(FE.update_from(part, new, "p_partkey", ["buildingtype"]), "p_partkey:l p_brand:s buildingtype:l")


def lod_layers(spark, sf):
    """Three model layers with the building attributes."""
    li = A.table(spark, sf, "lineitem").selectExpr("l_orderkey AS identificatie", "l_linenumber", "l_partkey", "l_returnflag")
    pand = A.table(spark, sf, "orders").withColumnRenamed("o_orderkey", "identificatie")
    out = None
    for name, flag in (("lod12", "A"), ("lod13", "N"), ("lod22", "R")):
        layer = W.lod_layer(li.filter(F.col("l_returnflag") == flag), pand, ["o_orderstatus", "o_totalprice"])
        layer = layer.withColumn("layer", F.lit(name))
        out = layer if out is None else out.unionByName(layer)
    return A.shaped(out, "layer:s identificatie:l l_linenumber:l l_partkey:l o_orderstatus:s o_totalprice:d")


def not_done(spark, sf):
    """Evaluation rows with defaults for customers without an order."""
    o = A.table(spark, sf, "orders").filter("o_orderstatus = 'P' AND o_totalprice > 400000")
    done = o.groupBy(F.col("o_custkey").cast("string").alias("identificatie")).agg(F.count("*").alias("n"))
    inputs = A.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("identificatie"))
    seen = done.select(
        F.col("identificatie").alias("id"), "identificatie", *[F.lit(1).alias(k) for k in D.LODS],
        F.lit(True).alias("has_geometry"), *[F.col("n").cast("string").alias(a) for a in D.EVALUATED],
    )
    rows = D.feature_rows(seen, Q.not_reconstructed(inputs, done))
    return A.shaped(rows, "id:s identificatie:s lod_0:l lod_22:l has_geometry:b b3_pw_bron:s")


def profile(spark, sf):
    """A10: NULL counts per column."""
    o = A.table(spark, sf, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END AS cust",
        "CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS prio", "CAST(o_totalprice AS double) AS price",
    )
    return A.shaped(Q.profile(o), "column_name:s column_type:s missing_values:l row_count:l")


def extent(spark, sf):
    """Overall box over all vertices, axes swapped."""
    o = A.boxes(A.table(spark, sf, "orders"), "o_orderkey", "o_orderkey AS fid")
    return A.shaped(Q.extent(o, swap=True, rings="rings"), "x0:d y0:d x1:d y1:d")


def layer_info(spark, sf):
    """Feature count, extent and attributes of a layer."""
    o = A.boxes(A.table(spark, sf, "orders"), "o_orderkey", "o_orderkey AS fid", "o_orderstatus AS status")
    return A.shaped(Q.layer_info(o, ["fid"]), "attribute:s type:s constraint:s feature_count:l x0:d y0:d x1:d y1:d")


def unique(spark, sf):
    """K5: keys that occur more than once."""
    return A.shaped(Q.assert_unique(A.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]), "l_orderkey:l l_linenumber:l n_rows:l")


def references(spark, sf):
    """K6: child rows without a parent."""
    child = A.table(spark, sf, "orders").withColumnRenamed("o_custkey", "key")
    parent = A.table(spark, sf, "customer").filter("c_acctbal > 0").withColumnRenamed("c_custkey", "key")
    return A.shaped(Q.assert_references(child, parent, "key"), "o_orderkey:l key:l")


def insert_ignore(spark, sf):
    """K2, K3: new keys are added, rows already there stay."""
    target = A.table(spark, sf, "supplier").selectExpr("s_suppkey AS id", "s_name AS name")
    new = A.table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name")
    return A.shaped(target.unionByName(sinks.new_rows(new, target, "id")), "id:l name:s")


def checksums(spark, sf):
    """File hashes against a manifest."""
    d = A.table(spark, sf, "documents")
    name = F.concat(F.lit("f"), F.col("doc_id").cast("string"))
    files = d.select(name.alias("file"), F.sha2("text", 256).alias("hash"), F.md5("text").alias("md5"))
    line = F.when(F.col("n_chars") % 5 == 0, name).otherwise(
        F.concat(F.when(F.col("n_chars") % 7 == 0, F.md5("text")).otherwise(F.sha2("text", 256)), F.lit("  "), name)
    )
    manifest = SF.parse_checksums(d.filter("source <> 'src5'").select(line.alias("value")))
    got = Q.verify_checksums(files, manifest).join(files.select("file", "md5"), "file")
    return A.shaped(got, "file:s hash:s md5:s status:s")


def drift(spark, sf):
    """Keys only one list has."""
    new = A.table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    known = A.table(spark, sf, "part").select(F.col("p_partkey").alias("k"))
    return A.shaped(Q.list_drift(new, known, "k"), "k:l only_in:s")


EVENT_LOG = (
    "CASE event_type WHEN 'click' THEN 'bag.extract_bag' WHEN 'view' THEN 'bag.bag_pandactueelbestaand' "
    "WHEN 'error' THEN 'top10nl.extract_top10nl' WHEN 'signup' THEN 'input.reconstruction_input' ELSE 'other' END"
)


def run_log(spark, sf):
    return A.table(spark, sf, "events").selectExpr(
        f"{EVENT_LOG} AS asset", "CAST(event_id AS string) AS run_id", "CASE WHEN value > 20 THEN user_id END AS rows",
        "ts", "CAST(value AS string) AS data_version",
    )


def latest(spark, sf):
    """Newest event per asset."""
    return A.shaped(L.latest_runs(run_log(spark, sf)), "name:s runId:s featureCount:l dateTime:s")


def latest_from_files(spark, sf):
    """The run log written as JSON lines, read back, and its newest event per asset."""
    path = f"{shared_dir(spark).rstrip('/')}/gevel-log-{uuid.uuid4().hex}"
    run_log(spark, sf).write.json(path)
    return A.shaped(L.latest_runs(SF.read_run_log(spark, path)), "name:s runId:s featureCount:l dateTime:s")


def csv_table(spark, sf):
    """Orders written as CSV with quoted text, and read back with their types."""
    path = f"{shared_dir(spark).rstrip('/')}/gevel-csv-{uuid.uuid4().hex}"
    rows = A.table(spark, sf, "orders").selectExpr(
        "o_orderkey AS id", "o_totalprice AS price", "concat('\"', o_orderpriority, '\", ', o_orderstatus) AS note", "array(o_orderstatus, CAST(o_custkey AS string)) AS parts",
        "CASE WHEN o_custkey % 3 > 0 THEN o_orderstatus END AS maybe",
    )
    sinks.write_csv(rows, path, quote_text=True)
    back = SF.read_csv_table(spark, path, "id long, price double, note string, parts string, maybe string")
    return A.shaped(back, "id:l price:d note:s parts:s maybe:s")


def lineage(spark, sf):
    """The lineage document, read back member by member."""
    doc = L.lineage_metadata(
        run_log(spark, sf), {"title": "models", "edition": "v1"}, [{"name": "register"}, {"name": "points", "date": ["2014", "2019"]}],
        [{"name": "spark", "version": "4"}], {"register": "bag.extract_bag"},
    )
    step = "struct<name:string,runId:string,featureCount:bigint,dateTime:string,dataVersion:string>"
    src = "struct<source:struct<name:string,date:string>>"
    ddl = (
        "identificationInfo struct<citation:struct<title:string,edition:string>>, dataQualityInfo struct<lineage:struct<"
        f"processStep:array<{step}>,source:array<{src}>,software:array<struct<name:string,version:string>>>>"
    )
    d = doc.select(F.from_json("doc", ddl).alias("d"))
    lin = F.col("d.dataQualityInfo.lineage")
    got = d.select(
        F.posexplode(lin["processStep"]).alias("pos", "s"), F.col("d.identificationInfo.citation.edition").alias("edition"),
        F.size(lin["source"]).alias("n_sources"), lin["software"][0]["name"].alias("software"),
        (lin["source"][0]["source"]["date"] == lin["processStep"][0]["dataVersion"]).alias("dated"),
        lin["source"][1]["source"]["date"].alias("fixed_date"),
    )
    got = got.withColumns({"name": F.col("s.name"), "runId": F.col("s.runId"), "dateTime": F.col("s.dateTime")})
    return A.shaped(got, "pos:l name:s runId:s dateTime:s edition:s n_sources:l software:s dated:b fixed_date:s")


def types_per_date(spark, sf):
    """Feature types by day, limited to the wanted ones."""
    e = A.table(spark, sf, "events").select(
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("date"), F.col("event_type").alias("featuretype")
    )
    got = L.types_per_date(e, ["view", "click", "missing"]).withColumn("featuretypes", F.array_join("featuretypes", ","))
    return A.shaped(got, "day:s featuretypes:s")


STEP_MS = {s: f"(l_partkey * {i + 3} + l_linenumber * 7) % {997 + 10 * i}" for i, s in enumerate(L.STEPS)}


def timing_lines(spark, sf):
    """Log lines of one timing per order line; some are malformed or of another kind."""
    li = A.table(spark, sf, "lineitem")
    path = "concat('/data/6/240/8/objects/P', l_orderkey, '/reconstruct/P', l_orderkey, '.city.jsonl')"
    pairs = ", '),', ".join(f"'({s}, ', {e}" for s, e in STEP_MS.items())
    bad = "CASE WHEN l_discount > 0.09 THEN concat('(', 'extrude, x),', '') ELSE '' END"
    return li.selectExpr(
        f"CASE WHEN l_returnflag = 'N' AND l_linenumber = 7 THEN concat('[reconstructor] finish: ', {path}) "
        f"ELSE concat('2024-11-29 [stdout] [debug] [reconstructor t] ', {path}, ' (', {bad}, {pairs}, '),)') END AS value"
    )


def log_times(spark, sf):
    """Median and mean per step over distinct buildings."""
    got = L.step_statistics(L.log_timings(timing_lines(spark, sf)))
    got = got.withColumn("mean", F.round("mean", 6)).withColumn("median", F.round("median", 6))
    return A.shaped(got, "step:s median:d mean:d")


def slow(spark, sf):
    """buildings whose steps take long together."""
    return A.shaped(L.slow_buildings(L.log_timings(timing_lines(spark, sf)), limit=6500), "building_id:s total:l")


TIMES_CTE = (
    "t AS (SELECT 'P' || l_orderkey AS building_id, " + ", ".join(f"{e} AS \"{s}\"" for s, e in STEP_MS.items())
    + " FROM lineitem WHERE NOT (l_returnflag = 'N' AND l_linenumber = 7) AND l_discount <= 0.09),\n"
    "one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY building_id ORDER BY "
    + ", ".join(f'"{s}"' for s in STEP_MS) + ") AS rn FROM t) WHERE rn = 1)"
)


def unfinished(spark, sf):
    """Buildings with a start and no finish."""
    o = A.table(spark, sf, "orders")
    path = "'/data/1/2/3/objects/P', o_orderkey, '/reconstruct/P', o_orderkey, '.city.jsonl'"
    lines = o.selectExpr(f"concat('x [reconstructor] start: ', {path}) AS value").unionByName(
        o.filter("o_orderstatus <> 'P'").selectExpr(f"concat('x [reconstructor] finish: ', {path}) AS value")
    )
    return A.shaped(L.unfinished(lines), "building_id:s")


def method_times(spark, sf):
    """Median, mean and deviation per method."""
    got = L.method_statistics(A.table(spark, sf, "events"), "event_type", "value")
    got = got.select("event_type", *[F.round(c, 6).alias(c) for c in ("median", "avg", "sd")])
    return A.shaped(got, "event_type:s median:d avg:d sd:d")


FEATURE_NUMBERS = {
    "no_vertices": "p_size", "perimeter": "p_retailprice", "no_units": "1 + p_size % 9", "net_area": "p_partkey % 400",
    "building_function": "p_partkey % 6", "no_neighbours_100": "CASE WHEN p_size > 10 THEN p_size END",
    "no_adjacent_neighbours": "CASE WHEN p_size > 30 THEN p_size % 4 END", "cbs_percent_multihousehold": "p_partkey % 100",
    "cbs_pop_per_km2": "p_partkey % 5000", "cbs_dist_to_horeca": "p_partkey % 17", "buildingtype": "p_partkey % 6",
}
BUILDING_NUMBERS = {
    "construction_year": "1000 + p_partkey % 1040", "h_roof_50p": "p_size / 2.0",
    "h_roof_70p": "CASE WHEN p_partkey % 8 > 0 THEN p_size / 2.0 + 1 END", "h_roof_max": "p_size * 7.0", "h_roof_min": "p_size / 4.0",
    "area_roof": "p_size * 3.0", "area_ext_walls": "p_size * 4.0", "area_party_walls": "p_size * 0.5", "area_ground": "p_size * 2.0",
    "volume_lod22": "p_size * 20.0", "volume_lod12": "p_size * 21.0",
}
ROOF = "CASE p_type WHEN 'PROMO' THEN 'horizontal' WHEN 'LARGE' THEN 'multiple horizontal' WHEN 'SMALL' THEN 'slanted' ELSE 'other' END"


def feature_tables(spark, sf):
    p = A.table(spark, sf, "part")
    ext = p.selectExpr("CAST(p_partkey AS string) AS identificatie", *[f"{e} AS {n}" for n, e in FEATURE_NUMBERS.items()])
    bld = p.filter("p_brand <> 'Brand#3'").selectExpr(
        "CAST(p_partkey AS string) AS id", f"{ROOF} AS roof_type", *[f"{e} AS {n}" for n, e in BUILDING_NUMBERS.items()]
    )
    return ext, bld


INPUTS = [*FEATURE_NUMBERS, "roof_type", *BUILDING_NUMBERS]


def features(spark, sf):
    """Feature matrix of residential buildings."""
    got = FE.training_filter(FE.all_features(*feature_tables(spark, sf)))
    return A.shaped(got, "identificatie:s " + " ".join(f"{c}:d" for c in INPUTS))


def floors(spark, sf):
    """Floors by boosted trees that were stored and read again; a step of one column is found exactly."""
    parts = A.table(spark, sf, "part").selectExpr("concat('P', p_partkey) AS identificatie", "p_size % 10 AS height", "nullif(p_size % 3, 0) AS units")
    model = M.fit_floors(parts.withColumn("floors", F.when(F.col("height") < 4, 2.0).otherwise(5.0)), ["height", "units"], rounds=3)
    path = f"{shared_dir(spark).rstrip('/')}/gevel-model-{uuid.uuid4().hex}"
    M.save_model(model, path)
    return A.shaped(M.predictions(M.predict_floors(parts, M.load_model(path), ["height", "units"])), "identificatie:s b3_bouwlagen:l")


def floors_of_features(spark, sf):
    """G11, G12 on J6, F8: floors predicted by boosted trees over the feature matrix; rows are the answer, values depend on the fit."""
    df = FE.training_filter(FE.all_features(*feature_tables(spark, sf)))
    known = df.withColumn("floors", F.col("h_roof_70p").cast("double") / 3)
    model = M.fit_floors(known, INPUTS, rounds=3)
    return A.shaped(M.predictions(M.predict_floors(df, model, INPUTS)), "identificatie:s b3_bouwlagen:l")


def publish(spark, sf):
    """Rounded half to even; more than five floors are not published."""
    li = A.table(spark, sf, "lineitem").groupBy("l_orderkey").agg((F.sum("l_quantity") / 32).alias("floors"))
    return A.shaped(D.publish_floors(li), "l_orderkey:l floors:d floors_int:d b3_bouwlagen:l")


def current_layer(spark, sf):
    """A register layer in its output columns, one row per id."""
    r = register_rows(spark, sf).withColumn("oorspronkelijkbouwjaar", F.lit(1990)).withColumn("wkb_geometry", F.col("geometry"))
    for c in H.HISTORY_COLUMNS:
        if c not in r.columns:
            r = r.withColumn(c, F.lit(None).cast("string"))
    rows = H.layer_snapshot(r, "pand", H.reference_date("1999-01-01"), excluded=[])
    return A.shaped(H.dedupe(rows, "identificatie", ["fid"]), "fid:l identificatie:s oorspronkelijkbouwjaar:l status:s documentnummer:s")


LAYER_STATUS = [
    "Naamgeving uitgegeven", "Naamgeving ingetrokken", "Woonplaats aangewezen", "Woonplaats ingetrokken", "Verblijfsobject in gebruik",
    "Verblijfsobject ingetrokken", "Verblijfsobject buiten gebruik", "Niet gerealiseerd verblijfsobject",
]


def register_layers(spark, sf):
    """Addresses, streets, towns and units as of a date, with the statuses each layer leaves out."""
    o = A.table(spark, sf, "orders")
    status = F.element_at(F.array(*map(F.lit, LAYER_STATUS)), (F.col("o_custkey") % len(LAYER_STATUS) + 1).cast("int"))
    out = None
    for layer in ("verblijfsobject", "nummeraanduiding", "openbareruimte", "woonplaats"):
        own = H.LAYER_COLUMNS[layer]
        nulls = [F.lit(None).cast("timestamp").alias(c) for c in H.HISTORY_COLUMNS if c not in ("identificatie", "status", "begingeldigheid", "tijdstipregistratielv")]
        rows = o.select(
            F.col("o_orderkey").alias("ogc_fid"), F.concat(F.lit("N"), F.col("o_orderkey").cast("string")).alias("identificatie"), status.alias("status"),
            F.col("o_orderdate").alias("begingeldigheid"), F.col("o_orderdate").alias("tijdstipregistratielv"), *nulls,
            *[F.concat(F.lit(c), F.col("o_orderpriority")).alias(c) for c in own], F.lit("g").alias("wkb_geometry"),
        )
        got = H.layer_snapshot(rows, layer, H.reference_date("1997-01-01"))
        part = got.select(F.lit(layer).alias("layer"), "fid", "status", F.col(own[-1]).alias("last_own"), F.lit(len(got.columns)).alias("n_columns"))
        out = part if out is None else out.unionByName(part)
    return A.shaped(out, "layer:s fid:l status:s last_own:s n_columns:l")


def topographic(spark, sf):
    """Topographic buildings with polygon shape, in their types."""
    p = A.boxes(A.table(spark, sf, "part"), "p_partkey", "p_partkey", "p_type", "p_brand", "p_size")
    two = F.when(F.col("p_size") % 4 == 0, F.array("rings", "rings")).otherwise(F.array("rings"))
    text = {"bronbeschrijving": "p_type", "mutatietype": "p_brand", "hoogteklasse": "p_brand", "status": "p_type", "soortnaam": "p_brand"}
    numbers = {"bronnauwkeurigheid": "p_size / 4.0", "hoogteniveau": "p_size", "visualisatiecode": "p_size * 2", "tdncode": "p_size + 1"}
    layer = p.select(
        F.col("p_partkey").alias("ogc_fid"), F.concat("p_type", "p_type").alias("namespace"), F.col("p_partkey").cast("string").alias("lokaalid"), F.col("p_type").alias("brontype"),
        *[F.col(c).alias(k) for k, c in text.items()], *[F.expr(f"cast({e} as string)").alias(k) for k, e in numbers.items()], F.array("p_type").alias("typegebouw"),
        F.array("p_brand").alias("naam"), F.lit("2001-02-03").alias("bronactualiteit"), F.lit("2001-02-03 04:05:06").alias("objectbegintijd"), F.lit("x").alias("tijdstipregistratie"), two.alias("geometry"),
    ).withColumn("tijdstipregistratie", F.lit(None).cast("string"))
    got = RC.topographic_buildings(layer).withColumn("area", (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")))
    return A.shaped(
        got.withColumn("day", F.col("bronactualiteit").cast("string")).withColumn("kind", F.col("typegebouw")[0]),
        "fid:l namespace:s lokaalid:l brontype:s day:s bronnauwkeurigheid:d hoogteniveau:l visualisatiecode:l tdncode:l kind:s area:d",
    )


def dates(spark, sf):
    """Version, ISO and short date texts."""
    o = A.table(spark, sf, "orders").select(
        "o_orderkey", TX.version_date("o_orderdate").alias("version"), TX.iso_date("o_orderdate").alias("iso"),
        TX.short_date("o_orderdate").alias("short"),
    )
    return A.shaped(o, "o_orderkey:l version:s iso:s short:s")


def _unpivot_sql() -> str:
    rows = [f"SELECT '{s}' AS step, \"{s}\" AS ms FROM one" for s in STEP_MS]
    return (
        f"WITH {TIMES_CTE} SELECT step, round(quantile_cont(ms, 0.5), 6) AS median, round(avg(ms), 6) AS mean FROM ("
        + " UNION ALL ".join(rows) + ") GROUP BY 1"
    )


_NUM = ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in {**FEATURE_NUMBERS, **BUILDING_NUMBERS}.items())

def fine_quantiles(spark, sf):
    """Quantiles of groups with very many different, unevenly spread values."""
    v = "(l_orderkey * 8 + l_linenumber) * 7919 % 1000003"
    rows = A.table(spark, sf, "lineitem").selectExpr("l_returnflag AS kind", f"CAST({v} * ({v}) AS double) AS v")
    got = group_quantiles(rows, ["kind"], "v", {"q25": 0.25, "q50": 0.5, "q90": 0.9})
    return A.shaped(got.select("kind", *[F.round(c, 2).alias(c) for c in ("q25", "q50", "q90")]), "kind:s q25:d q50:d q90:d")


FINE_SQL = """
WITH r AS (SELECT l_returnflag AS kind, CAST((l_orderkey * 8 + l_linenumber) * 7919 % 1000003 AS DOUBLE) AS w FROM lineitem)
SELECT kind, round(quantile_cont(w * w, 0.25), 2) AS q25, round(quantile_cont(w * w, 0.5), 2) AS q50, round(quantile_cont(w * w, 0.9), 2) AS q90 FROM r GROUP BY kind"""

LATEST_SQL = f"""SELECT asset AS name, CAST(event_id AS VARCHAR) AS runId, CASE WHEN value > 20 THEN user_id END AS featureCount, strftime(ts, '%Y-%m-%d') AS dateTime
        FROM (SELECT *, {EVENT_LOG} AS asset, row_number() OVER (PARTITION BY {EVENT_LOG} ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) AS rn FROM events) WHERE rn = 1"""

QUERIES = {
    "csv_table": (
        csv_table,
        """SELECT o_orderkey AS id, o_totalprice AS price, '"' || o_orderpriority || '", ' || o_orderstatus AS note, '[' || o_orderstatus || ', ' || o_custkey || ']' AS parts,
        CASE WHEN o_custkey % 3 > 0 THEN o_orderstatus END AS maybe FROM orders""",
    ),
    "fine_quantiles": (fine_quantiles, FINE_SQL),
    "dedupe": (
        dedupe,
        """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_extendedprice FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_suppkey, l_linenumber) AS rn FROM lineitem) WHERE rn = 1""",
    ),
    "update_from": (
        update_from,
        """WITH u AS (SELECT l_partkey, min(CASE l_linenumber WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 1 ELSE 5 END) AS t
          FROM lineitem WHERE l_returnflag = 'R' AND l_discount > 0.07 GROUP BY 1)
        SELECT p_partkey, p_brand, CAST(t AS BIGINT) AS buildingtype FROM part LEFT JOIN u ON p_partkey = l_partkey""",
    ),
    "lod_layers": (
        lod_layers,
        """SELECT CASE l_returnflag WHEN 'A' THEN 'lod12' WHEN 'N' THEN 'lod13' ELSE 'lod22' END AS layer, l_orderkey AS identificatie,
        CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, o_orderstatus, o_totalprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
    "not_done": (
        not_done,
        """WITH d AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000 GROUP BY 1)
        SELECT CAST(k AS VARCHAR) AS id, CAST(k AS VARCHAR) AS identificatie, CAST(CASE WHEN n IS NULL THEN 0 ELSE 1 END AS BIGINT) AS lod_0,
        CAST(CASE WHEN n IS NULL THEN 0 ELSE 1 END AS BIGINT) AS lod_22, n IS NOT NULL AS has_geometry, CAST(n AS VARCHAR) AS b3_pw_bron
        FROM (SELECT c_custkey AS k FROM customer UNION SELECT o_custkey FROM d) LEFT JOIN d ON k = o_custkey""",
    ),
    "profile": (
        profile,
        """WITH s AS (SELECT count(*) AS n, count(*) FILTER (o_orderkey % 3 = 0) AS a, count(*) FILTER (o_orderstatus = 'F') AS b FROM orders)
        SELECT column_name, column_type, CAST(CASE column_name WHEN 'cust' THEN a WHEN 'prio' THEN b ELSE 0 END AS BIGINT) AS missing_values, n AS row_count
        FROM s, (VALUES ('o_orderkey', 'bigint'), ('cust', 'bigint'), ('prio', 'string'), ('price', 'double')) v(column_name, column_type)""",
    ),
    "extent": (
        extent,
        f"SELECT min(y0) AS x0, min(x0) AS y0, max(y1) AS x1, max(x1) AS y1 FROM (SELECT {A.box_sql('o_orderkey')} FROM orders)",
    ),
    "layer_info": (
        layer_info,
        f"""WITH b AS (SELECT {A.box_sql('o_orderkey')} FROM orders)
        SELECT attribute, type, "constraint", count(*) AS feature_count, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1
        FROM b, (VALUES ('fid', 'bigint', 'NOT NULL'), ('status', 'string', '')) v(attribute, type, "constraint") GROUP BY 1, 2, 3""",
    ),
    "unique": (
        unique,
        "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    ),
    "references": (
        references,
        "SELECT o_orderkey, o_custkey AS key FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)",
    ),
    "insert_ignore": (
        insert_ignore,
        """SELECT s_suppkey AS id, s_name AS name FROM supplier UNION ALL
        SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""",
    ),
    "checksums": (
        checksums,
        """SELECT 'f' || doc_id AS file, sha256(text) AS hash, md5(text) AS md5, CASE WHEN source = 'src5' THEN 'unlisted' WHEN n_chars % 5 = 0 THEN 'no_hash'
        WHEN n_chars % 7 = 0 THEN 'mismatch' ELSE 'ok' END AS status FROM documents""",
    ),
    "drift": (
        drift,
        """SELECT coalesce(c_custkey, p_partkey) AS k, CASE WHEN p_partkey IS NULL THEN 'new' ELSE 'known' END AS only_in
        FROM customer FULL JOIN part ON c_custkey = p_partkey WHERE c_custkey IS NULL OR p_partkey IS NULL""",
    ),
    "latest_from_files": (latest_from_files, LATEST_SQL),
    "latest": (
        latest,
        LATEST_SQL,
    ),
    "lineage": (
        lineage,
        f"""WITH l AS (SELECT asset, event_id, ts FROM (SELECT *, {EVENT_LOG} AS asset,
          row_number() OVER (PARTITION BY {EVENT_LOG} ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) AS rn FROM events) WHERE rn = 1 AND asset <> 'other')
        SELECT row_number() OVER (ORDER BY CASE asset WHEN 'bag.extract_bag' THEN 1 WHEN 'bag.bag_pandactueelbestaand' THEN 2
          WHEN 'top10nl.extract_top10nl' THEN 3 ELSE 5 END) - 1 AS pos, asset AS name, CAST(event_id AS VARCHAR) AS runId,
          strftime(ts, '%Y-%m-%d') AS dateTime, 'v1' AS edition, CAST(2 AS BIGINT) AS n_sources, 'spark' AS software, true AS dated,
          '["2014","2019"]' AS fixed_date FROM l""",
    ),
    "types_per_date": (
        types_per_date,
        """SELECT strftime(ts, '%Y-%m-%d') AS day, coalesce(array_to_string(list_sort(list(DISTINCT event_type) FILTER (event_type IN ('view', 'click'))), ','), '') AS featuretypes
        FROM events GROUP BY 1""",
    ),
    "log_times": (log_times, _unpivot_sql()),
    "slow": (
        slow,
        f"WITH {TIMES_CTE}, s AS (SELECT building_id, " + " + ".join(f'"{s}"' for s in STEP_MS)
        + " AS total FROM one) SELECT building_id, CAST(total AS BIGINT) AS total FROM s WHERE total > 6500",
    ),
    "unfinished": (unfinished, "SELECT 'P' || o_orderkey AS building_id FROM orders WHERE o_orderstatus = 'P'"),
    "method_times": (
        method_times,
        "SELECT event_type, round(quantile_cont(value, 0.5), 6) AS median, round(avg(value), 6) AS avg, round(stddev_samp(value), 6) AS sd FROM events GROUP BY 1",
    ),
    "features": (
        features,
        f"""SELECT CAST(p_partkey AS VARCHAR) AS identificatie, {_NUM}, CAST(CASE p_type WHEN 'PROMO' THEN 0 WHEN 'LARGE' THEN 0 WHEN 'SMALL' THEN 1 END AS DOUBLE) AS roof_type
        FROM part WHERE p_brand <> 'Brand#3' AND p_partkey % 6 IN (0, 1) AND 1000 + p_partkey % 1040 > 1005 AND 1000 + p_partkey % 1040 < 2025
          AND p_size * 7.0 < 300 AND p_partkey % 8 > 0""",
    ),
    "floors": (
        floors,
        "SELECT 'P' || p_partkey AS identificatie, CAST(CASE WHEN p_size % 10 < 4 THEN 2 ELSE 5 END AS BIGINT) AS b3_bouwlagen FROM part",
    ),
    "floors_of_features": (floors_of_features, None),
    "publish": (
        publish,
        """SELECT l_orderkey, floors, round_even(floors, 0) AS floors_int, CASE WHEN round_even(floors, 0) <= 5 THEN CAST(round_even(floors, 0) AS BIGINT) END AS b3_bouwlagen
        FROM (SELECT l_orderkey, sum(l_quantity) / 32 AS floors FROM lineitem GROUP BY 1)""",
    ),
    "current_layer": (
        current_layer,
        f"""WITH r AS ({REGISTER_SQL}), c AS (SELECT *, row_number() OVER (PARTITION BY identificatie ORDER BY ogc_fid) AS rn FROM r
          WHERE coalesce(tijdstipinactieflv > TIMESTAMP '1999-01-01', true) AND coalesce(tijdstipnietbaglv > TIMESTAMP '1999-01-01', true)
          AND tijdstipregistratielv <= TIMESTAMP '1999-01-01' AND coalesce(tijdstipeindregistratielv > TIMESTAMP '1999-01-01', true)
          AND begingeldigheid <= TIMESTAMP '1999-01-01' AND coalesce(eindgeldigheid = begingeldigheid OR eindgeldigheid > TIMESTAMP '1999-01-01', true))
        SELECT ogc_fid AS fid, identificatie, CAST(1990 AS BIGINT) AS oorspronkelijkbouwjaar, status, CAST(NULL AS VARCHAR) AS documentnummer FROM c WHERE rn = 1""",
    ),
    "register_layers": (
        register_layers,
        f"""WITH s AS (SELECT *, list_extract({LAYER_STATUS!r}, CAST(o_custkey % {len(LAYER_STATUS)} AS INT) + 1) AS status FROM orders WHERE o_orderdate <= TIMESTAMP '1997-01-01')
        SELECT layer, o_orderkey AS fid, status, own || o_orderpriority AS last_own, CAST(n AS BIGINT) AS n_columns FROM s, (VALUES
          ('verblijfsobject', 'pandref', 22, ['Niet gerealiseerd verblijfsobject', 'Verblijfsobject ingetrokkent', 'Verblijfsobject buiten gebruik']),
          ('nummeraanduiding', 'openbareruimteref', 23, ['Naamgeving ingetrokken']), ('openbareruimte', 'woonplaatsref', 20, ['Naamgeving ingetrokken']),
          ('woonplaats', 'naam', 18, ['Woonplaats ingetrokken'])) l(layer, own, n, gone) WHERE NOT list_contains(gone, status)""",
    ),
    "topographic": (
        topographic,
        f"""SELECT p_partkey AS fid, substr(p_type || p_type, 1, 10) AS namespace, p_partkey AS lokaalid, substr(p_type, 1, 12) AS brontype, '2001-02-03' AS day,
        CAST(p_size / 4.0 AS DOUBLE) AS bronnauwkeurigheid, CAST(p_size AS BIGINT) AS hoogteniveau, CAST(p_size * 2 AS BIGINT) AS visualisatiecode, CAST(p_size + 1 AS BIGINT) AS tdncode,
        p_type AS kind, (x1 - x0) * (y1 - y0) AS area FROM (SELECT *, {A.box_sql('p_partkey')} FROM part) WHERE p_size % 4 <> 0""",
    ),
    "dates": (
        dates,
        "SELECT o_orderkey, strftime(o_orderdate, '%Y.%m.%d') AS version, strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate, '%d%m%Y') AS short FROM orders",
    ),
}
