"""Sinks (K1, K3, K4, K7): partitioned aligned rows, points and centres CSVs,
delimited text. Every sink is a distributed write; nothing is collected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread_over

# Fixed value: the header of the points and centres CSVs (with its space).
POINTS_HEADER = ["filewrites", "filereads", "CPU", "diskIOBW", "net bytes"]


def write_aligned(aligned: DataFrame, path: str, fmt: str = "parquet", parts: int = 4) -> None:
    """K1: one folder per server and day (``partitionBy``), each written by up to
    ``parts`` tasks (an hour goes to one of them), replacing only the
    partitions written (dynamic overwrite). Empty server-days write nothing
    (K2). ``fmt='csv'`` writes the six headerless columns of the original."""
    cols = ["time", "filewrites", "filereads", "CPU", "diskIOBW", "net_bytes"]
    hours = F.pmod(F.floor(F.col("time") / 3600), F.lit(parts))
    out = aligned.select(*cols, "server", "day").repartition("server", "day", hours)
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("server", "day")
    if fmt == "csv":
        w.option("header", False).csv(path)
    else:
        w.parquet(path)


def write_points_csv(points: DataFrame, path: str, features: Sequence[str] | None = None) -> None:
    """K3: points with the five-column header (``net_bytes`` -> ``net bytes``)."""
    feats = list(features or ["filewrites", "filereads", "CPU", "diskIOBW", "net_bytes"])
    out = points.select(*[F.col(c).alias(h) for c, h in zip(feats, POINTS_HEADER)])
    out.write.mode("overwrite").option("header", True).csv(path)


def write_centers_csv(centers: DataFrame, path: str, features: Sequence[str] | None = None) -> None:
    """K4: centres, same header, ordered by cluster id in one small file
    (k rows per group)."""
    feats = list(features or ["filewrites", "filereads", "CPU", "diskIOBW", "net_bytes"])
    out = centers.orderBy("cluster_id").select(*[F.col(c).alias(h) for c, h in zip(feats, POINTS_HEADER)])
    out.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


NAMED_HEADER = "name string, filewrites double, filereads double, CPU double, diskIOBW double, `net bytes` double"


def write_named(points: DataFrame, centers: DataFrame, path: str) -> None:
    """K3-K5 for many results at once: ``points`` and ``centers`` (name, features)
    go to ``points/name=...`` and ``centers/name=...`` with the five-column header, one
    distributed write each; only names written again are replaced. The manifest
    (name, n_points, n_centers) is written last, so a result is seen whole or not
    at all (``read_named``). A name of more than a partition's size is written by
    several tasks, small ones share a task. Centres and the manifest are few rows
    but a file a name, so their names are dealt out to a fixed number of tasks."""
    feats = ["filewrites", "filereads", "CPU", "diskIOBW", "net_bytes"]
    sizes, parts = None, spread_over(points.sparkSession)
    for df, kind in ((points, "points"), (centers, "centers")):
        out = df.select("name", *[F.col(c).alias(h) for c, h in zip(feats, POINTS_HEADER)])
        out = out.hint("rebalance", "name") if kind == "points" else out.repartition(parts, "name")
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("header", True).partitionBy("name").csv(f"{path}/{kind}"))
        n = df.groupBy("name").agg(F.count(F.lit(1)).alias(f"n_{kind}"))
        sizes = n if sizes is None else sizes.join(n, "name", "left").fillna(0)
    (sizes.repartition(parts, "name").withColumn("of", F.col("name")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("of").parquet(f"{path}/manifest"))


def read_named(spark, path: str) -> DataFrame:
    """(name, kind, features) of the results in the manifest; raises where a
    result does not hold the rows the manifest says."""
    manifest = spark.read.parquet(f"{path}/manifest").drop("of")
    kinds = []
    for kind in ("points", "centers"):
        rows = spark.read.schema(NAMED_HEADER).option("header", True).csv(f"{path}/{kind}")
        kinds.append(rows.withColumnRenamed("net bytes", "net_bytes").withColumn("kind", F.lit(kind[:-1])))
    found = kinds[0].unionByName(kinds[1]).join(manifest.select("name"), "name", "left_semi")
    counts = found.groupBy("name").agg(F.count_if(F.col("kind") == "point").alias("p"), F.count_if(F.col("kind") == "center").alias("c"))
    torn = manifest.join(counts, "name", "left").where("n_points <> coalesce(p, 0) OR n_centers <> coalesce(c, 0)")
    if not torn.isEmpty():
        raise ValueError(f"{path}: results that do not match their manifest")
    return found


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> None:
    """K7: delimited text; fields holding the quote, the delimiter or a line
    break are quoted and quotes doubled."""
    (df.write.mode("overwrite").option("header", header).option("sep", sep)
     .option("quote", '"').option("escape", '"').option("quoteAll", False).csv(path))
