"""Domain shapes made from the test tables with integer arithmetic.

The SQL texts next to the functions give the same shapes. Boxes lie in towns of 20 000
keys, 2048 units apart, so their density does not grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gevel.functions import geometry as G


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def shaped(df: DataFrame, ddl: str) -> DataFrame:
    """Final column order and types, ``name:type`` separated by blanks."""
    pairs = [c.split(":") for c in ddl.split()]
    types = {"l": "bigint", "d": "double", "s": "string", "b": "boolean"}
    return df.select(*[F.col(n).cast(types[t]).alias(n) for n, t in pairs])


def box_sql(key: str, w: str = "5+j%11", h: str = "5+j%7", town: bool = True) -> str:
    """Select list for x0, y0, x1, y1 (SQL of both engines except for the division)."""
    off = f"({key} - {key} % 20000) * 2048 / 20000" if town else "0"
    j = f"({key} % 20000)"
    w, h = w.replace("j", j), h.replace("j", j)
    x0 = f"({off} + ({j}*{j}*31 + {j}*7919) % 1999)"
    y0 = f"(({j}*{j}*17 + {j}*104729) % 2003)"
    return (
        f"CAST({x0} AS DOUBLE) AS x0, CAST({y0} AS DOUBLE) AS y0, "
        f"CAST({x0} + {w} AS DOUBLE) AS x1, CAST({y0} + {h} AS DOUBLE) AS y1"
    )


def boxes(df: DataFrame, key: str, *cols: str, w: str = "5+j%11", h: str = "5+j%7", town: bool = True) -> DataFrame:
    out = df.selectExpr(*cols, *_split(box_sql(key, w, h, town)))
    return out.withColumn("rings", G.box_rings(*G.BOX))


def _split(select: str) -> list[str]:
    return [part.strip() for part in select.split(", ")]


def slanted(df: DataFrame) -> DataFrame:
    """The boxes seen with (x + y) / 2 and (x - y) / 2 as coordinates: turned by 45 degrees, half the area."""
    turn = lambda p: G.point((p.x + p.y) / 2, (p.x - p.y) / 2)
    rest = [c for c in df.columns if c not in (*G.BOX, "rings")]
    return G.with_bbox(df.select(*rest, F.transform("rings", lambda r: F.transform(r, turn)).alias("rings")))


GREENHOUSE = dict(w="20+j%17", h="20+j%13")
TILE = dict(w="5+(j%11)*40", h="5+(j%7)*40", town=False)

# regions: one rectangle per nation on a 5 x 5 board of 400 units
NATION_SQL = (
    "SELECT n_nationkey AS k, CAST(n_nationkey % 5 * 400 AS DOUBLE) AS x0, "
    "CAST((n_nationkey - n_nationkey % 5) / 5 * 400 AS DOUBLE) AS y0, "
    "CAST(n_nationkey % 5 * 400 + 400 AS DOUBLE) AS x1, "
    "CAST((n_nationkey - n_nationkey % 5) / 5 * 400 + 400 AS DOUBLE) AS y1, n_name FROM nation"
)


def nations(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("n_nationkey")
    x0, y0 = (k % 5 * 400).cast("double"), (F.floor(k / 5) * 400).cast("double")
    out = table(spark, sf, "nation").select(
        k.cast("long").alias("k"), x0.alias("x0"), y0.alias("y0"), (x0 + 400).alias("x1"), (y0 + 400).alias("y1"), "n_name"
    )
    return out.withColumn("rings", G.box_rings(*G.BOX))


LINE_POINT = "CAST((l_partkey*7919 + l_orderkey*31) % 1999 AS DOUBLE) AS x, CAST((l_suppkey*104729 + l_orderkey*17) % 2003 AS DOUBLE) AS y"


def line_points(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(*cols, *_split(LINE_POINT))
