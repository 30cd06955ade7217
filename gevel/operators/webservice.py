"""Tables for the web service: attribute layers and tile validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gevel.functions.rows import by_merge
from gevel.functions.text import typed_or_null
from gevel.operators.quality import VALIDATION_SCHEMA

# Building attributes every model layer carries, in the order of the published tables.
LAYER_ATTRIBUTES = [
    "b3_bag_bag_overlap",
    "b3_n_vlakken",
    "b3_pw_onvoldoende",
    "b3_t_run",
    "b3_succes",
    "b3_extrusie",
    "b3_is_glas_dak",
    "b3_dak_type",
    "b3_h_maaiveld",
    "b3_kas_warenhuis",
    "b3_mutatie_AHN3_AHN4",
    "b3_mutatie_AHN4_AHN5",
    "b3_nodata_fractie_AHN3",
    "b3_nodata_fractie_AHN4",
    "b3_nodata_fractie_AHN5",
    "b3_nodata_radius_AHN3",
    "b3_nodata_radius_AHN4",
    "b3_nodata_radius_AHN5",
    "b3_opp_buitenmuur",
    "b3_opp_dak_plat",
    "b3_opp_dak_schuin",
    "b3_opp_grond",
    "b3_opp_scheidingsmuur",
    "b3_puntdichtheid_AHN3",
    "b3_puntdichtheid_AHN4",
    "b3_puntdichtheid_AHN5",
    "b3_pw_bron",
    "b3_pw_datum",
    "b3_pw_selectie_reden",
    "b3_rmse_lod12",
    "b3_rmse_lod13",
    "b3_rmse_lod22",
    "b3_val3dity_lod12",
    "b3_val3dity_lod13",
    "b3_val3dity_lod22",
    "b3_volume_lod12",
    "b3_volume_lod13",
    "b3_volume_lod22",
    "b3_bouwlagen",
    "b3_kwaliteitsindicator",
    "begingeldigheid",
    "documentdatum",
    "documentnummer",
    "eindgeldigheid",
    "eindregistratie",
    "geconstateerd",
    "oorspronkelijkbouwjaar",
    "status",
    "tijdstipeindregistratielv",
    "tijdstipinactief",
    "tijdstipinactieflv",
    "tijdstipnietbaglv",
    "tijdstipregistratie",
    "tijdstipregistratielv",
    "voorkomenidentificatie",
]


def lod_layer(layer: DataFrame, buildings: DataFrame, attributes=None) -> DataFrame:
    """A model layer with the building attributes, joined on ``identificatie``."""
    cols = LAYER_ATTRIBUTES if attributes is None else list(attributes)
    return layer.join(by_merge(buildings.select("identificatie", *cols)), "identificatie")


def webservice_tiles(index: DataFrame, validation: DataFrame, schema=VALIDATION_SCHEMA) -> DataFrame:
    """Typed validation results with the tile polygon."""
    return typed_or_null(validation, schema).join(
        index.select("tile_id", F.col("wkt").alias("geometry")), "tile_id"
    )
