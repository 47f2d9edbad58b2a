"""Monthly observation files (A4): a preamble, then a header line whose first
cell is blank, then one line per observation.

Files land in ``<root>/location=<code>/month=<yyyyMM>/…`` and are read by lines,
so a file of any size is split over tasks.  One small aggregate finds the header
line of every file; its names are resolved to positions once per file, and the
positions are joined to the data lines — so files with different header
spellings (or missing columns) are read in the same job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloop.functions.headers import DATE_ALIASES, FEATURE_ALIASES, normalise_header, pick

DEFAULT_ALIASES = {"Date": DATE_ALIASES, **FEATURE_ALIASES}


_CELLS = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'   # a comma with an even number of quotes after it parts cells

#: Where a line stands in its file: start of the file's block, then a growing number.
PLACE = ("block_start", "line_no")


def cells(line) -> F.Column:
    """The cells of a line: quoted cells may hold commas, doubled quotes stand for one."""
    return F.transform(F.split(line, _CELLS, -1), lambda c: F.regexp_replace(
        F.regexp_replace(F.trim(c), '^"(.*)"$', "$1"), '""', '"'))


def read_observation_files(spark: SparkSession, root: str,
                           aliases: Mapping[str, Sequence[str]] = DEFAULT_ALIASES) -> DataFrame:
    """One string column per target in ``aliases`` (NULL when the file lacks
    it), plus the partition columns found under ``root``, the file path and ``PLACE``."""
    raw = spark.read.text(root).select(
        "*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_no"))
    keep = [c for c in raw.columns if c != "value"]
    at = F.struct(*PLACE)
    # header = first line whose first cell is blank; a blank preamble line also
    # matches, and blank lines are skipped after it, as a CSV reader would do
    blank = F.trim("value") == ""
    starts = raw.filter(F.trim(F.substring_index("value", ",", 1)) == "").groupBy("file_path").agg(F.min(at).alias("__start"))
    heads = raw.filter(~blank).join(starts, "file_path").filter(at >= F.col("__start")).groupBy("file_path").agg(
        F.min(F.struct(at.alias("at"), F.col("value"))).alias("h"))
    names = F.transform(cells(F.col("h.value")), lambda h: normalise_header(h))
    entries = F.filter(F.arrays_zip(names.alias("k"), F.sequence(F.lit(1), F.size(names)).alias("v")),
                       lambda e: e["k"] != "")
    heads = heads.select("file_path", F.col("h.at").alias("__head"), F.map_from_entries(entries).alias("__map"))
    heads = heads.select("file_path", "__head", *[pick(F.col("__map"), al).alias(f"__at_{t}") for t, al in aliases.items()])
    rows = raw.filter(~blank).join(heads, "file_path").filter(at > F.col("__head")).withColumn("__cells", cells(F.col("value")))
    return rows.select(*keep, *[
        F.when(F.try_element_at("__cells", F.col(f"__at_{t}")) != "", F.try_element_at("__cells", F.col(f"__at_{t}"))).alias(t)
        for t in aliases])


def write_observation_files(df: DataFrame, root: str, station: str, month: str, shard: str,
                            header: F.Column, line: F.Column, order: Sequence[str]) -> None:
    """Land rows as files, one per (station, month, shard) directory, each file
    led by its own preamble + header (``header`` may differ per shard).

    Rows are hash-distributed on (station, month, shard), so a hot station is
    spread over its shards; the header row sorts first inside its file.
    """
    body = df.select(F.col(station).alias("location"), F.col(month).alias("month"),
                     F.col(shard).alias("shard"), F.lit(1).alias("__kind"),
                     *[F.col(c) for c in order], line.alias("value"))
    heads = df.select(F.col(station).alias("location"), F.col(month).alias("month"),
                      F.col(shard).alias("shard"), header.alias("value")).dropDuplicates(
        ["location", "month", "shard"]).withColumn("__kind", F.lit(0))
    for c in order:
        heads = heads.withColumn(c, F.lit(None).cast(df.schema[c].dataType))
    allrows = body.unionByName(heads)
    keys = ["location", "month", "shard"]
    (allrows.repartition(*keys).sortWithinPartitions(*keys, "__kind", *order)
     .select(*keys, "value").write.mode("overwrite").partitionBy(*keys).text(root))


def daily_truth(obs: DataFrame, measure: str = "Rainfall", measure_as: str = "rainfall",
                station: str = "location") -> DataFrame:
    """C1's truth side from landed files: one row per (station, date) with the
    measurement of the date's last line (file order), as the reference reads
    a month file's last row for a date.  Unparsable dates are dropped."""
    from labelloop.functions.dates import parse_date
    from labelloop.functions.values import safe_double
    from labelloop.operators.dedup import last_per_key
    rows = obs.select(F.col(station).cast("string").alias("location"), parse_date("Date").alias("obs_date"),
                      "file_path", *PLACE, safe_double(measure).alias(measure_as))
    rows = rows.filter(F.col("obs_date").isNotNull())
    return last_per_key(rows, ["location", "obs_date"], ["file_path", *PLACE]).drop("file_path", *PLACE)
