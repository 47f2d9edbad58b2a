"""Row filters, contracts and conforming projections (B1, B7, B10, B12, B15,
B17, B19, B20)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MissingColumns(ValueError):
    pass


def require_columns(df: DataFrame, required: Iterable[str], on_missing: str = "raise") -> bool:
    """Plan-time schema contract.  ``on_missing="raise"`` raises, ``"empty"``
    returns False so the caller can take its fallback branch."""
    missing = sorted(set(required) - set(df.columns))
    if missing and on_missing == "raise":
        raise MissingColumns(f"missing expected columns: {missing}")
    return not missing


def drop_unlabelled(df: DataFrame, label: str) -> DataFrame:
    """B1: rows with a NULL label are dropped."""
    return df.dropna(subset=[label])


def complete_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows missing any key are dropped."""
    return df.dropna(subset=list(keys))


def labelled_rows(scored: DataFrame, flag: str = "truth_available", label: str = "y_true") -> DataFrame:
    """Rows whose truth is known and whose label is present."""
    return scored.filter(F.col(flag) & F.col(label).isNotNull())


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def feature_roles(df: DataFrame, exclude: Iterable[str] = (),
                  calendar: Iterable[str] = ("Dayofyear", "Month")) -> DataFrame:
    """(column, role) inferred as a CSV reader would: numbers are
    ``numeric``, dates ``temporal``, and a text column is ``numeric`` when
    every non-missing value parses as a number, else ``categorical``.
    One aggregation pass compares non-NULL and parseable counts per text
    column; calendar and excluded columns are left out."""
    from labelloop.functions.values import na_to_null
    skip = set(exclude) | set(calendar)
    fields = [f for f in df.schema.fields if f.name not in skip]
    texts = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    checks = []
    for i, c in enumerate(texts):
        v = na_to_null(F.col(c))
        checks += [F.count(v).alias(f"__n{i}"), F.count(F.trim(v).try_cast("double")).alias(f"__p{i}")]
    row = df.agg(*checks).first() if checks else None
    rows = []
    for pos, f in enumerate(df.schema.fields):
        if f.name in skip:
            continue
        if isinstance(f.dataType, T.StringType):
            i = texts.index(f.name)
            role = "numeric" if row[f"__n{i}"] == row[f"__p{i}"] else "categorical"
        elif isinstance(f.dataType, _NUMERIC):
            role = "numeric"
        elif isinstance(f.dataType, _TEMPORAL):
            role = "temporal"
        else:
            continue
        rows.append((pos, f.name, role))
    return df.sparkSession.createDataFrame(rows, "position INT, column_name STRING, role STRING")


def role_lists(df: DataFrame, exclude: Iterable[str] = (),
               calendar: Iterable[str] = ("Dayofyear", "Month")) -> tuple[list[str], list[str]]:
    """B7 as Python lists, read from the schema only (no job is run)."""
    skip = set(exclude) | set(calendar)
    cats = [f.name for f in df.schema.fields if f.name not in skip and isinstance(f.dataType, T.StringType)]
    nums = [f.name for f in df.schema.fields if f.name not in skip and isinstance(f.dataType, _NUMERIC)]
    return cats, nums


def conform(df: DataFrame, target: T.StructType | Sequence[tuple[str, str]]) -> DataFrame:
    """Add missing target columns as typed NULLs, cast and order as the target."""
    fields = [(f.name, f.dataType) for f in target.fields] if isinstance(target, T.StructType) \
        else [(n, T._parse_datatype_string(t)) for n, t in target]
    cols = []
    for name, dtype in fields:
        if name in df.columns:
            cols.append(F.col(name).cast(dtype).alias(name))
        else:
            cols.append(F.lit(None).cast(dtype).alias(name))
    return df.select(*cols)


def parse_payload(df: DataFrame, text_col: str, schema: T.StructType,
                  required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """JSON text → typed row; rows lacking a required field go to a reject branch."""
    parsed = df.withColumn("__p", F.from_json(F.col(text_col), schema))
    ok = F.lit(True)
    for r in required:
        ok = ok & F.col(f"__p.{r}").isNotNull()
    ok = F.coalesce(ok, F.lit(False))
    accepted = parsed.filter(ok).select("__p.*")
    rejected = parsed.filter(~ok).drop("__p")
    return accepted, rejected


def select_by_alias(df: DataFrame, mapping: Mapping[str, str | None]) -> DataFrame:
    """Project to target names from picked source columns; None → NULL."""
    return df.select(*[F.col(src).alias(dst) if src else F.lit(None).cast("string").alias(dst)
                       for dst, src in mapping.items()])
