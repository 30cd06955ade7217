"""Text helpers: typed casts, bracket lists, links, ids and dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID_PREFIX = "NL.IMBAG.Pand."


def blank_to_null(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.length(c) > 0, c)


def bracket_list(c: Column | str, kind: str = "int") -> Column:
    """``'[102, 203]'`` as an array; ``'[]'`` is empty, blank or NULL is NULL.

    Text elements keep their quotes and blanks, as they stand between the commas.
    """
    c = blank_to_null(c)
    body = F.translate(c, "[]", "")
    parts = F.when(F.length(body) == 0, F.array().cast("array<string>")).otherwise(F.split(body, ","))
    if kind in ("int", "integer"):
        return F.transform(parts, lambda p: F.trim(p).cast("int"))
    return parts


def typed_or_null(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Casts text columns to the schema; empty text becomes NULL. Arrays are bracket lists."""
    out = []
    for f in schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            kind = "int" if isinstance(f.dataType.elementType, T.IntegerType) else "string"
            out.append(bracket_list(f.name, kind).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            out.append(F.col(f.name).cast("string").alias(f.name))
        else:
            out.append(blank_to_null(f.name).cast(f.dataType).alias(f.name))
    return df.select(*out)


def file_id(tile_id: Column | str) -> Column:
    return F.translate(tile_id, "/", "-")


# File name ending per distribution format.
LINK_ENDINGS = {"cityjson": ".city.json.gz", "gpkg": ".gpkg.gz", "obj": "-obj.zip"}


def download_link(fmt: Column | str, fid: Column | str, version: Column | str, root: str) -> Column:
    """Address of a tile file; formats outside :data:`LINK_ENDINGS` raise."""
    fmt, fid, version = (F.col(c) if isinstance(c, str) else c for c in (fmt, fid, version))
    ending = F.create_map(*[F.lit(v) for kv in LINK_ENDINGS.items() for v in kv])[fmt]
    link = F.concat_ws(
        "/", F.lit(root), F.translate(version, ".", ""), F.lit("tiles"),
        F.translate(fid, "-", "/"), F.concat(fid, ending),
    )
    return F.when(ending.isNotNull(), link).otherwise(
        F.raise_error(F.concat(F.lit("only cityjson, obj, gpkg format is allowed, got "), F.coalesce(fmt, F.lit("NULL"))))
    )


def feature_stem(path: Column | str) -> Column:
    """Building id of ``…/<id>.city.jsonl``."""
    return F.regexp_extract(path, r"([^/]+)\.city\.jsonl?$", 1)


def building_id(digits: Column | str) -> Column:
    return F.concat(F.lit(ID_PREFIX), digits)


def version_date(d: Column | str) -> Column:
    return F.date_format(d, "yyyy.MM.dd")


def iso_date(d: Column | str) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def short_date(d: Column | str) -> Column:
    return F.date_format(d, "ddMMyyyy")
