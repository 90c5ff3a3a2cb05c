"""K-means result tables (SNK6-SNK9, M10).

Two input shapes are accepted:
* the nested result of M10 - one row per cluster with its points and
  distances - which is exploded (`explode(arrays_zip(...))`), and
* flat points (label, ip, coords) with a centre table (label, coords),
  which is the shape to prefer at scale: each point is joined to its centre
  and its distance computed in place, so no cluster is gathered into one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schema as S

def coords_text(coords: Column) -> Column:
    """Coordinates `#`-joined, each as the JVM prints a double."""
    return F.concat_ws("#", F.transform(coords, lambda x: x.cast("string")))


def euclidean(a: Column, b: Column) -> Column:
    sq = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(sq, F.lit(0.0).cast("double"), lambda acc, v: acc + v))


def centres_of(points: DataFrame, digits: int = 6) -> DataFrame:
    """Mean of each coordinate per label (rounded), as (label, coords).

    One average per coordinate, all in one aggregate with partial sums on the map side: a point is one
    row throughout, and a label that holds a third of all points still shuffles one row per task.
    """
    n = points.agg(F.max(F.size("coords"))).first()[0] or 0
    means = F.array(*[F.round(F.avg(F.get("coords", F.lit(i))), digits) for i in range(n)]).cast("array<double>")
    return points.groupBy("label").agg(F.filter(means, lambda x: x.isNotNull()).alias("coords"))


def point_rows(points: DataFrame, centres: DataFrame, clno: str, cltime: str, demo: str,
               digits: int = 6) -> DataFrame:
    """SNK6 (flat form): one T_SIEM_KMEANS_CLUSTER row per point.

    The centres are a small table by nature, but nothing bounds their size
    here: Spark picks the join, a broadcast where their real size allows it.
    """
    c = centres.select("label", F.col("coords").alias("centre"))
    joined = points.join(c, "label")
    return joined.select(
        F.md5(F.concat_ws("~", F.lit("cluster"), F.lit(clno), F.col("ip"), F.col("label").cast("string"))).alias("row"),
        F.lit(clno).alias("clno"),
        F.col("ip").alias("name"),
        F.col("label").cast("string").alias("center_index"),
        F.round(euclidean(F.col("coords"), F.col("centre")), digits).alias("distance"),
        coords_text(F.col("coords")).alias("center_info"),
        F.to_timestamp(F.lit(cltime)).alias("cltime"),
        F.lit(demo).alias("demo"),
    )


def point_rows_nested(result: DataFrame, clno: str, cltime: str, demo: str) -> DataFrame:
    """SNK6 (nested form): explode each cluster's points with their distances."""
    ex = result.select("label", F.explode(F.arrays_zip("points", "distances")).alias("pd"))
    return ex.select(
        F.md5(F.concat_ws("~", F.lit("cluster"), F.lit(clno), F.col("pd.points.ip"), F.col("label").cast("string"))).alias("row"),
        F.lit(clno).alias("clno"),
        F.col("pd.points.ip").alias("name"),
        F.col("label").cast("string").alias("center_index"),
        F.col("pd.distances").alias("distance"),
        coords_text(F.col("pd.points.coords")).alias("center_info"),
        F.to_timestamp(F.lit(cltime)).alias("cltime"),
        F.lit(demo).alias("demo"),
    )


def centre_rows(centres: DataFrame, clno: str, cltime: str, ty: int) -> DataFrame:
    """SNK7: one level-one T_SIEM_KMEANS_CENTER row per centre (index = label)."""
    return centres.select(
        F.md5(F.concat_ws("~", F.lit("centre"), F.lit(clno), F.col("label").cast("string"))).alias("row"),
        F.col("label").cast("string").alias("center_index"),
        coords_text(F.col("coords")).alias("center_info"),
        F.lit(clno).alias("clno"),
        F.lit(ty).cast("int").alias("type"),
        F.to_timestamp(F.lit(cltime)).alias("cltime"),
        F.lit(S.CENTER_DEMO_LEVEL1).alias("demo"),
    )


def centre_rows_level2(centres: DataFrame, clno_parent: str, index_parent: int, clno: str,
                       cltime: str, ty: int) -> DataFrame:
    """SNK8: level-two centres with the parent cluster run and parent centre."""
    return centres.select(
        F.md5(F.concat_ws("~", F.lit("centre2"), F.lit(clno), F.col("label").cast("string"))).alias("row"),
        F.col("label").cast("string").alias("center_index"),
        F.lit(str(index_parent)).alias("center_index_p"),
        coords_text(F.col("coords")).alias("cluster_info"),
        F.lit(clno).alias("clno"),
        F.lit(clno_parent).alias("clno_p"),
        F.lit(ty).cast("int").alias("type"),
        F.to_timestamp(F.lit(cltime)).alias("cltime"),
        F.lit(S.CENTER_DEMO_LEVEL2).alias("demo"),
    )


# --- fixed values: the stored columns ---
BATCH_COLUMNS = ["row", "name", "center_index", "center_info", "clno", "type", "cltime", "demo",
                 "center_index_p", "clno_p"]
# --- end of fixed values ---


def centre_rows_batch(rows: DataFrame) -> DataFrame:
    """SNK9: ten text columns -> typed centre rows (type INT, cltime TIMESTAMP).

    Unreadable numbers or times become null rather than failing the batch.
    """
    typed = {"type": F.col("type").try_cast("int"), "cltime": F.try_to_timestamp(F.col("cltime"))}
    return rows.select(*[typed.get(c, F.col(c)).alias(c) for c in BATCH_COLUMNS])
