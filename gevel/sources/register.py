"""Register and topographic layers from XML and GML files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gevel.functions import geometry as G

# Three-letter file code of each register layer.
LAYER_CODES = {
    "inactief": "inactief",
    "inonderzoek": "inonderzoek",
    "ligplaats": "lig",
    "nietbag": "nietbag",
    "nummeraanduiding": "num",
    "openbareruimte": "opr",
    "pand": "pnd",
    "standplaats": "sta",
    "verblijfsobject": "vbo",
    "woonplaats": "wpl",
}
# XML element of each layer that is loaded.
LAYER_ELEMENTS = {
    "pand": "Pand",
    "verblijfsobject": "Verblijfsobject",
    "nummeraanduiding": "Nummeraanduiding",
    "openbareruimte": "OpenbareRuimte",
    "woonplaats": "Woonplaats",
    "ligplaats": "Ligplaats",
    "standplaats": "Standplaats",
}

_ID = "struct<_VALUE:string,_domein:string>"
_RING = "struct<LinearRing:struct<posList:string>>"
_POLYGON = f"struct<exterior:{_RING},interior:array<{_RING}>>"
_SURFACES = f"array<struct<Polygon:{_POLYGON}>>"
_SHAPE = (
    f"struct<Polygon:{_POLYGON},MultiSurface:struct<surfaceMember:{_SURFACES}>,"
    f"Point:struct<pos:string>,punt:struct<Point:struct<pos:string>>,vlak:struct<Polygon:{_POLYGON}>,"
    f"multivlak:struct<MultiSurface:struct<surfaceMember:{_SURFACES}>>>"
)
_VOORKOMEN = (
    "struct<Voorkomen:struct<voorkomenidentificatie:int,beginGeldigheid:timestamp,eindGeldigheid:timestamp,"
    "tijdstipRegistratie:timestamp,eindRegistratie:timestamp,tijdstipInactief:timestamp,"
    "BeschikbaarLV:struct<tijdstipRegistratieLV:timestamp,tijdstipEindRegistratieLV:timestamp,"
    "tijdstipInactiefLV:timestamp,tijdstipNietBagLV:timestamp>>>"
)
_COMMON = (
    f"identificatie {_ID}, status string, geconstateerd string, documentdatum date, documentnummer string, "
    f"voorkomen {_VOORKOMEN}, geometrie {_SHAPE}"
)
_EXTRA = {
    "pand": "oorspronkelijkBouwjaar int",
    "verblijfsobject": (
        "gebruiksdoel array<string>, oppervlakte int, "
        f"maaktDeelUitVan struct<PandRef:array<{_ID}>>, "
        f"heeftAlsHoofdadres struct<NummeraanduidingRef:{_ID}>, "
        f"heeftAlsNevenadres struct<NummeraanduidingRef:array<{_ID}>>"
    ),
    "nummeraanduiding": (
        "huisnummer int, huisletter string, huisnummertoevoeging string, postcode string, "
        f"typeAdresseerbaarObject string, ligtAan struct<OpenbareRuimteRef:{_ID}>"
    ),
    "openbareruimte": f"naam string, type string, ligtIn struct<WoonplaatsRef:{_ID}>",
    "woonplaats": "naam string",
    **dict.fromkeys(
        ("ligplaats", "standplaats"),
        f"heeftAlsHoofdadres struct<NummeraanduidingRef:{_ID}>, heeftAlsNevenadres struct<NummeraanduidingRef:array<{_ID}>>",
    ),
}


def register_schema(layer: str) -> str:
    return f"{_COMMON}, {_EXTRA[layer]}"


def _ref(c: Column) -> Column:
    """Register ids carry their domain as a prefix."""
    return F.concat_ws(".", c["_domein"], c["_VALUE"])


def pos_list(c: Column, dims: int = 3) -> Column:
    """Coordinate text as a ring; values beyond x and y are dropped."""
    v = F.split(F.trim(c), r"\s+")
    n = F.floor(F.size(v) / dims).cast("int")
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1))
    return F.transform(at, lambda i: G.point(F.get(v, i * dims), F.get(v, i * dims + 1)))


def _rings(polygon: Column, dims: int) -> Column:
    holes = F.coalesce(polygon["interior"], F.array().cast(f"array<{_RING}>"))
    every = F.concat(F.array(polygon["exterior"]), holes)
    return F.transform(every, lambda r: pos_list(r["LinearRing"]["posList"], dims))


def _parts(g: Column, dims: int) -> Column:
    def many(surface: Column) -> Column:
        return F.transform(surface["surfaceMember"], lambda m: _rings(m["Polygon"], dims))

    def one(polygon: Column) -> Column:
        return F.when(polygon.isNotNull(), F.array(_rings(polygon, dims)))

    return F.coalesce(
        one(g["Polygon"]), one(g["vlak"]["Polygon"]), many(g["MultiSurface"]), many(g["multivlak"]["MultiSurface"])
    )


def _flat(raw: DataFrame, layer: str, dims: int) -> DataFrame:
    v = F.col("voorkomen")["Voorkomen"]
    lv = v["BeschikbaarLV"]
    addresses = lambda: [
        _ref(F.col("heeftAlsHoofdadres")["NummeraanduidingRef"]).alias("hoofdadresnummeraanduidingref"),
        F.transform(F.col("heeftAlsNevenadres")["NummeraanduidingRef"], _ref).alias("nevenadresnummeraanduidingref"),
    ]
    extra = {
        "pand": lambda: [F.col("oorspronkelijkBouwjaar").alias("oorspronkelijkbouwjaar")],
        "verblijfsobject": lambda: [
            F.col("gebruiksdoel"), F.col("oppervlakte"), *addresses(),
            F.transform(F.col("maaktDeelUitVan")["PandRef"], _ref).alias("pandref"),
        ],
        "nummeraanduiding": lambda: [
            F.col("huisnummer"), F.col("huisletter"), F.col("huisnummertoevoeging"), F.col("postcode"),
            F.col("typeAdresseerbaarObject").alias("typeadresseerbaarobject"),
            _ref(F.col("ligtAan")["OpenbareRuimteRef"]).alias("openbareruimteref"),
        ],
        "openbareruimte": lambda: [
            F.col("naam"), F.col("type"), _ref(F.col("ligtIn")["WoonplaatsRef"]).alias("woonplaatsref"),
        ],
        "woonplaats": lambda: [F.col("naam")],
        "ligplaats": addresses,
        "standplaats": addresses,
    }[layer]()
    point = F.coalesce(F.col("geometrie")["Point"]["pos"], F.col("geometrie")["punt"]["Point"]["pos"])
    xy = F.split(F.trim(point), r"\s+")
    return raw.select(
        *[c for c in raw.columns if c in ("ogc_fid",)],
        _ref(F.col("identificatie")).alias("identificatie"),
        "status", (F.lower("geconstateerd").isin("j", "true")).alias("geconstateerd"), "documentdatum", "documentnummer",
        v["voorkomenidentificatie"].alias("voorkomenidentificatie"),
        v["beginGeldigheid"].alias("begingeldigheid"), v["eindGeldigheid"].alias("eindgeldigheid"),
        v["tijdstipRegistratie"].alias("tijdstipregistratie"), v["eindRegistratie"].alias("eindregistratie"),
        v["tijdstipInactief"].alias("tijdstipinactief"),
        lv["tijdstipRegistratieLV"].alias("tijdstipregistratielv"),
        lv["tijdstipEindRegistratieLV"].alias("tijdstipeindregistratielv"),
        lv["tijdstipInactiefLV"].alias("tijdstipinactieflv"), lv["tijdstipNietBagLV"].alias("tijdstipnietbaglv"),
        *extra,
        _parts(F.col("geometrie"), dims).alias("geometry"),
        F.when(point.isNotNull(), G.point(xy[0], xy[1])).alias("point"),
    )


def parse_register(df: DataFrame, layer: str, xml: str = "xml", dims: int = 3) -> DataFrame:
    """Register objects from rows that hold one XML element each."""
    doc = F.from_xml(F.col(xml), register_schema(layer), {"ignoreNamespace": "true"})
    keep = [c for c in df.columns if c == "ogc_fid"]
    return _flat(df.select(*keep, doc.alias("_x")).select(*keep, "_x.*"), layer, dims)


def _in_bbox(df: DataFrame, bbox: Sequence[float] | None) -> DataFrame:
    if bbox is None:
        return df
    boxes = F.transform("geometry", G.bbox)
    x0, y0, x1, y1 = (float(v) for v in bbox)
    meets = F.exists(boxes, lambda b: (b.x0 <= x1) & (b.x1 >= x0) & (b.y0 <= y1) & (b.y1 >= y0))
    at = F.col("point.x").between(x0, x1) & F.col("point.y").between(y0, y1)
    return df.filter(F.coalesce(meets, at))


def read_register_xml(
    spark: SparkSession, path: str, layer: str, bbox: Sequence[float] | None = None, dims: int = 3,
) -> DataFrame:
    """All objects of one register layer; with ``bbox`` only those whose box meets it.

    ``path`` is a folder or glob of the layer's XML files.
    """
    raw = (
        spark.read.format("xml").option("rowTag", LAYER_ELEMENTS[layer.lower()]).option("ignoreNamespace", "true")
        .schema(register_schema(layer.lower())).load(path)
    )
    return _in_bbox(_flat(raw, layer.lower(), dims), bbox)


def layer_folder(extract: str, layer: str, date: str) -> str:
    """Folder of a layer below an unpacked extract; ``date`` is its day as ddmmyyyy."""
    return f"{extract.rstrip('/')}/9999{LAYER_CODES[layer.lower()].upper()}{date}"


def read_register_layer(
    spark: SparkSession, extract: str, layer: str, date: str, kind: str | None = None, bbox: Sequence[float] | None = None, dims: int = 3,
) -> DataFrame:
    """One of the ten layers of an extract, with ``ogc_fid`` and ``wkb_geometry``, as ``layer_snapshot`` takes it.

    The layers ``inactief``, ``inonderzoek`` and ``nietbag`` hold objects of other layers; ``kind`` says of which. The
    number of a row is a hash of its id, its occurrence and its time of registration, the same in every run.
    ``wkb_geometry`` has the polygon parts, or the point.
    """
    rows = read_register_xml(spark, layer_folder(extract, layer, date), kind or layer, bbox, dims)
    number = F.xxhash64("identificatie", "voorkomenidentificatie", "tijdstipregistratielv")
    return rows.withColumn("ogc_fid", number).withColumn("wkb_geometry", F.struct(F.col("geometry").alias("parts"), "point"))


def read_gml_layer(
    spark: SparkSession, path: str, feature: str, columns: str, geometry: str = "geometrieVlak", dims: int = 2,
) -> DataFrame:
    """Features of a GML file with the given columns (DDL) and their polygon parts."""
    raw = (
        spark.read.format("xml").option("rowTag", feature).option("ignoreNamespace", "true")
        .schema(f"{columns}, {geometry} {_SHAPE}").load(path)
    )
    parts = _parts(F.col(geometry), dims).alias("geometry")
    return raw.select(*[c for c in raw.columns if c != geometry], parts)
