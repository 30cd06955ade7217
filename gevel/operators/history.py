"""Bitemporal snapshots and survivor choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Status values that end a life cycle, per register layer. The unit list
# keeps the source's misspelt third letter group, so withdrawn units pass by default.
EXCLUDED_STATUSES = {
    "pand": ["Niet gerealiseerd pand", "Pand gesloopt", "Bouwvergunning verleend"],
    "verblijfsobject": [
        "Niet gerealiseerd verblijfsobject",
        "Verblijfsobject ingetrokkent",
        "Verblijfsobject buiten gebruik",
        "Verblijfsobject ten onrechte opgevoerd",
    ],
    "nummeraanduiding": ["Naamgeving ingetrokken"],
    "openbareruimte": ["Naamgeving ingetrokken"],
    "woonplaats": ["Woonplaats ingetrokken"],
}
# The same list with the status as the register spells it.
UNIT_STATUSES_CORRECTED = [
    "Niet gerealiseerd verblijfsobject",
    "Verblijfsobject ingetrokken",
    "Verblijfsobject buiten gebruik",
    "Verblijfsobject ten onrechte opgevoerd",
]

# Columns every register layer shares, in output order.
HISTORY_COLUMNS = [
    "identificatie", "status", "geconstateerd", "documentdatum", "documentnummer",
    "voorkomenidentificatie", "begingeldigheid", "eindgeldigheid", "tijdstipregistratie",
    "eindregistratie", "tijdstipinactief", "tijdstipregistratielv",
    "tijdstipeindregistratielv", "tijdstipinactieflv", "tijdstipnietbaglv",
]
# Columns of one layer only, placed before the shared ones.
LAYER_COLUMNS = {
    "pand": ["oorspronkelijkbouwjaar"],
    "verblijfsobject": [
        "gebruiksdoel", "oppervlakte", "hoofdadresnummeraanduidingref",
        "nevenadresnummeraanduidingref", "pandref",
    ],
    "nummeraanduiding": [
        "huisnummer", "huisletter", "huisnummertoevoeging", "postcode",
        "typeadresseerbaarobject", "openbareruimteref",
    ],
    "openbareruimte": ["naam", "type", "woonplaatsref"],
    "woonplaats": ["naam"],
}


def reference_date(text: str | None = None) -> Column:
    """``YYYY-MM-DD`` as a timestamp in the session zone; without it, now."""
    return F.to_timestamp(F.lit(text), "yyyy-MM-dd") if text else F.current_timestamp()


def _after(col: str, t: Column) -> Column:
    return F.col(col).isNull() | (F.col(col) > t)


def valid_at(
    t: Column,
    valid_from: str = "begingeldigheid",
    valid_to: str = "eindgeldigheid",
    registered: str = "tijdstipregistratielv",
    unregistered: str = "tijdstipeindregistratielv",
    inactive: str = "tijdstipinactieflv",
    outside: str = "tijdstipnietbaglv",
) -> Column:
    """Row is registered and valid at ``t``; a row that ends when it begins still counts."""
    known = (F.col(registered) <= t) & _after(unregistered, t)
    valid = (F.col(valid_from) <= t) & (
        _after(valid_to, t) | (F.col(valid_to) == F.col(valid_from))
    )
    return _after(inactive, t) & _after(outside, t) & known & valid


def snapshot_as_of(
    df: DataFrame, t: Column, excluded: Sequence[str] = (), status: str = "status", **columns: str
) -> DataFrame:
    """Rows current at ``t`` whose status is known and not excluded."""
    kept = df.filter(valid_at(t, **columns))
    return kept.filter(~F.col(status).isin(*excluded)) if excluded else kept


def layer_snapshot(df: DataFrame, layer: str, t: Column, excluded: Sequence[str] | None = None) -> DataFrame:
    """Snapshot of one register layer in its output columns."""
    cut = snapshot_as_of(df, t, EXCLUDED_STATUSES[layer] if excluded is None else excluded)
    return cut.select(
        F.col("ogc_fid").alias("fid"),
        *LAYER_COLUMNS[layer],
        *HISTORY_COLUMNS,
        F.col("wkb_geometry").alias("geometrie"),
    )


def dedupe(df: DataFrame, key: str | Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in ``order``.

    The rank limit is applied before the shuffle as well (partial group limit), so a key
    that holds a large share of the rows sends one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
