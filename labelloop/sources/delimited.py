"""Delimited-file scans (A1, A2) and the ragged prediction-log reader (A3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloop.functions.values import na_to_null
from labelloop.session import cut_lineage
from labelloop.sources.schemas import PREDICTION_LOG_V1, PREDICTION_LOG_V2

# Whitespace is data (' Yes ' must survive a round trip), so trimming is off.
_CSV_OPTS = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
             "mode": "PERMISSIVE"}


def read_delimited(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                   sep: str = ",") -> DataFrame:
    """A1: header CSV read with every column as a string (no inference pass),
    the reader's missing-value tokens turned into NULL.

    With ``columns`` the schema is fixed up front; otherwise the header is read
    (a tiny first-line job) to name the string columns.
    """
    reader = spark.read.options(**_CSV_OPTS).option("sep", sep)
    if columns is not None:
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
        df = reader.option("enforceSchema", "false").schema(schema).csv(path)
    else:
        df = reader.option("inferSchema", "false").csv(path)
    return df.select(*[na_to_null(c).alias(c) for c in df.columns])


def scan_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A2: column-pruned scan; Catalyst narrows the file ``ReadSchema`` to these."""
    return df.select(*columns)


# Quote-aware comma split: a comma separates fields only when an even number
# of quotes follows it on the line.
_FIELD_SPLIT = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def parse_log_fields(rows: DataFrame, fields_col: str = "fields", keep: Sequence[str] = ()) -> DataFrame:
    """A3: 7 fields → v1 (no feature_date), ≥ 8 fields → v2 (first 8 used),
    any other arity is dropped.  Values stay strings (typed by :func:`type_log`)."""
    t = rows.select(F.col(fields_col).alias("__f"), *keep).withColumn("__n", F.size("__f")).filter(F.col("__n") >= 7)
    v2 = F.col("__n") >= 8

    def at(i):
        return F.get(F.col("__f"), i)

    cols = []
    for name in PREDICTION_LOG_V2:
        i2 = PREDICTION_LOG_V2.index(name)
        if name in PREDICTION_LOG_V1:
            value = F.when(v2, at(i2)).otherwise(at(PREDICTION_LOG_V1.index(name)))
        else:
            value = F.when(v2, at(i2))
        cols.append(F.when(value != "", value).alias(name))  # empty field → NULL
    return t.select(*cols, *keep)


#: Where a log row stands: file, and a number that grows with its place in the file.
LOG_POSITION = ("source_file", "source_row")


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, source_file, source_row): the records of text files whose quoted fields may hold line breaks.

    Files are read line by line in blocks, by as many tasks as there are blocks.  A
    line starts a record where an even number of quotes stands before it in its
    file: quotes are counted per block, summed over the blocks of a file, and counted
    on inside the blocks.  Blocks in which no quote stays open (nearly all) need no
    more than that; the lines of the others are put together by record.
    ``source_row`` is the line of the file that the record starts in, from 1.
    """
    lines = spark.read.text(path).select(
        F.col("value"), F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), (F.length(F.regexp_replace("value", '[^"]', "")) % 2).alias("odd"))
    earlier = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    blocks = lines.groupBy("source_file", "block").agg(F.count(F.lit(1)).alias("n"), F.sum("odd").alias("odds"), F.min("id").alias("first"))
    # one row a block
    blocks = cut_lineage(blocks.select("source_file", "block", "n", "odds", "first", (before("odds") % 2).alias("open"), before("n").alias("lines")))
    row = (F.col("lines") + F.col("id") - F.col("first") + 1).alias("source_row")
    whole = lines.join(blocks.where("odds = 0 and open = 0").drop("n", "odds", "open"), ["source_file", "block"]).select(
        F.col("value").alias("record"), "source_file", row)
    inside = Window.partitionBy("source_file", "block").orderBy("source_row").rowsBetween(Window.unboundedPreceding, -1)
    torn = lines.join(blocks.where("odds > 0 or open = 1"), ["source_file", "block"]).select("value", "source_file", "block", "odd", "open", row)
    torn = torn.withColumn("starts", ((F.col("open") + F.coalesce(F.sum("odd").over(inside), F.lit(0))) % 2 == 0).cast("long"))
    torn = cut_lineage(torn)   # read for the counts and for the lines
    counts = blocks.join(torn.groupBy("source_file", "block").agg(F.sum("starts").alias("s")), ["source_file", "block"], "left")
    counts = counts.select("source_file", "block", before(F.coalesce("s", "n")).alias("records"))
    upto = Window.partitionBy("source_file", "block").orderBy("source_row")
    numbered = torn.withColumn("record_no", F.sum("starts").over(upto)).join(counts, ["source_file", "block"])
    joined = numbered.groupBy("source_file", (F.col("records") + F.col("record_no")).alias("r")).agg(
        F.sort_array(F.collect_list(F.struct("source_row", "value"))).alias("parts"))
    return whole.unionByName(joined.select(F.array_join("parts.value", "\n").alias("record"), "source_file",
                                           F.get("parts.source_row", 0).alias("source_row")))


def read_prediction_log(spark: SparkSession, path: str) -> DataFrame:
    """A3 on files: records → fields (strings), with ``LOG_POSITION``.

    Quoted fields may hold commas and line breaks (:func:`quoted_records`); each
    file's first record, the header, and blank lines are skipped.  The CSV parser takes
    records of eight fields; those of another number are split here.
    """
    schema = T.StructType([*(T.StructField(c, T.StringType()) for c in PREDICTION_LOG_V2), T.StructField("_raw", T.StringType())])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_raw",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "lineSep": "\u0001"}
    records = quoted_records(spark, path).where("source_row > 1 and record != ''")
    read = records.select(F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), options).alias("v"), *LOG_POSITION).select("v.*", *LOG_POSITION)
    split = F.transform(F.split("_raw", _FIELD_SPLIT, -1), lambda x: F.regexp_replace(
        F.regexp_replace(x, '(?s)^"(.*)"$', "$1"), '""', '"'))
    fields = F.when(F.col("_raw").isNull(), F.array(*[F.coalesce(c, F.lit("")) for c in PREDICTION_LOG_V2])).otherwise(split)
    return parse_log_fields(read.select(fields.alias("fields"), *LOG_POSITION), "fields", LOG_POSITION)


def type_log(raw: DataFrame) -> DataFrame:
    """B4/B8 on a raw log: timestamps (naive and offset mixed) to UTC, dates,
    probability and class as numbers; unparsable values become NULL."""
    from labelloop.functions.dates import parse_date, parse_timestamp
    from labelloop.functions.values import safe_double
    return raw.select(
        parse_timestamp("logged_at_utc").alias("logged_at"),
        parse_date("feature_date").alias("feature_date"),
        parse_date("target_date").alias("target_date"),
        "location", "use_latest", "station_name",
        safe_double("rain_probability").alias("rain_probability"),
        safe_double("predicted_rain").cast("int").alias("predicted_rain"),
        *[c for c in LOG_POSITION if c in raw.columns],
    )


def require_rows(df: DataFrame, what: str = "prediction log") -> DataFrame:
    """The reference's 'no usable rows' error, as an explicit (one-row) action."""
    if df.isEmpty():
        raise ValueError(f"No usable rows in {what}")
    return df
