"""Shelf-temperature log analysis.

Every line is parsed with regular expressions in the JVM; the report is one
grouping-sets aggregate, so many servers are summarised in one job with a
partial (map-side) aggregate before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The patterns of the original parser.
SHELF_WORD = "Shelf"
SHELF_PATTERN = r"sdisk\w\d-(?:rear|front)"
TEMP_PATTERN = r"(\d\d) C"
SERVER_PATTERN = r"sense\d"
# Corrected forms (option ``wide=True``): any number of digits, signed.
TEMP_PATTERN_WIDE = r"(-?\d+) C"
SERVER_PATTERN_WIDE = r"sense\d+"


def shelf_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """Keep lines that contain the word ``Shelf``."""
    return lines.where(F.col(text).contains(SHELF_WORD))


def extract_shelf(lines: DataFrame, text: str = "value", wide: bool = False) -> DataFrame:
    """Shelf id and temperature; lines lacking either are dropped.

    With the original two-digit pattern ``100 C`` reads as ``00`` (0) and
    ``9 C`` does not match.
    """
    shelf = F.regexp_extract(F.col(text), SHELF_PATTERN, 0)
    temp = F.regexp_extract(F.col(text), TEMP_PATTERN_WIDE if wide else TEMP_PATTERN, 1)
    server = F.regexp_extract(F.col(text), SERVER_PATTERN_WIDE if wide else SERVER_PATTERN, 0)
    return (shelf_lines(lines, text)
            .select("*", shelf.alias("shelf"), temp.alias("_temp"), server.alias("server"))
            .where((F.col("shelf") != "") & (F.col("_temp") != ""))
            .withColumn("temp_c", F.col("_temp").try_cast("int"))  # a number beyond an int is no temperature
            .where(F.col("temp_c").isNotNull()).drop("_temp"))


def server_name(lines: DataFrame, group: str = "dir", order: tuple[str, ...] = ("path", "line_id"),
                text: str = "value") -> DataFrame:
    """Per group, the server named in the first ``Shelf`` line (first
    file, first line); ``sense12`` reads as ``sense1`` as in the original."""
    s = shelf_lines(lines, text)
    first = F.min_by(F.col(text), F.struct(*[F.col(c) for c in order]))
    return (s.groupBy(group).agg(first.alias("_line"))
            .select(group, F.regexp_extract("_line", SERVER_PATTERN, 0).alias("server_name")))


def server_mean(parsed: DataFrame, group: str = "dir") -> DataFrame:
    """Mean temperature over all parsed lines of a group."""
    return parsed.groupBy(group).agg(F.avg("temp_c").alias("mean_temp"),
                                     F.count(F.lit(1)).alias("n_logs"))


def shelf_sum_count(parsed: DataFrame, group: str = "dir") -> DataFrame:
    """Sum and count of temperatures per shelf, sorted by shelf."""
    return (parsed.groupBy(group, "shelf")
            .agg(F.sum("temp_c").cast("long").alias("sum_temp"), F.count(F.lit(1)).alias("n_logs"))
            .orderBy(group, "shelf"))


def shelf_report(parsed: DataFrame, group: str = "dir") -> DataFrame:
    """Per group the server mean (``shelf`` null) and each shelf's mean,
    in one ``GROUPING SETS ((group, shelf), (group))`` aggregate."""
    return (parsed.rollup(group, "shelf")
            .agg(F.sum("temp_c").alias("_s"), F.count(F.lit(1)).alias("n_logs"),
                 F.grouping_id().cast("int").alias("level"))
            .where(F.col("level") < 3)
            .select(group, "shelf", "level", "n_logs",
                    (F.col("_s") / F.col("n_logs")).alias("mean_temp")))
