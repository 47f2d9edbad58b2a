"""Seeded, stratified hold-out split and k-fold assignment (H8, H9).

Rows are ordered inside their class by ``md5(seed ‖ key)`` (then the key),
which is a reproducible shuffle that any engine can recompute.  Positions
come from :func:`labelloop.operators.ordering.global_rank` in its bucket
mode: the leading hash digits give evenly filled, order-preserving buckets,
so a class with billions of rows is ranked by many tasks, with no sampling
pass and no materialised copy.

``exact=False`` skips ranking: a row goes to the test side when its hash,
read as a fraction, is below the test share — no shuffle at all, class
shares hold in expectation rather than exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloop.operators.ordering import global_rank

# ---- fixed values ----------------------------------------------------------
SEED = 42
TEST_SHARE = 0.2
FOLDS = 5
BUCKETS = 16        # hash buckets of a class per partition: a few large ones would meet in some partitions and miss others
# ---------------------------------------------------------------------------


def shuffle_key(key: str, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")))


def _hash_bucket(key: str, seed: int, buckets: int) -> Column:
    """Bucket from the first 15 hex digits of the shuffle key: non-decreasing
    in the key's order and evenly spread, so ranks need no range sampling."""
    h = F.conv(F.substring(shuffle_key(key, seed), 1, 15), 16, 10).cast("decimal(20,0)")
    return F.floor(h * F.lit(buckets) / F.lit(16 ** 15)).cast("int")


def _ranked(df: DataFrame, label: str, key: str, seed: int) -> DataFrame:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return global_rank(df.withColumn("__h", shuffle_key(key, seed)), ["__h", key], [label], "__r",
                       bucket=_hash_bucket(key, seed, n * BUCKETS))


def _hash_fraction(key: str, seed: int) -> Column:
    # first 8 hex digits of the md5 as an integer in [0, 2^32), scaled to [0, 1)
    h = F.conv(F.substring(shuffle_key(key, seed), 1, 8), 16, 10).cast("double")
    return h / F.lit(float(2 ** 32))


def stratified_split(df: DataFrame, label: str, key: str, test_share: float = TEST_SHARE,
                     seed: int = SEED, exact: bool = True, split_col: str = "split") -> DataFrame:
    """H8: ``split`` = 'test' for round(share · n_class) rows of every class, else 'train'."""
    if not exact:
        return df.withColumn(split_col, F.when(_hash_fraction(key, seed) < test_share, "test")
                             .otherwise("train"))
    ranked = _ranked(df, label, key, seed)
    # a class's size is its last rank: no second pass over the source
    sizes = ranked.groupBy(label).agg(F.max("__r").alias("__n"))
    out = ranked.join(F.broadcast(sizes.withColumnRenamed(label, "__lab")),   # a row per class; a join by class has a task per class
                      on=F.col(label).eqNullSafe(F.col("__lab")), how="inner")
    n_test = F.round(F.col("__n") * F.lit(float(test_share)), 0)
    return out.withColumn(split_col, F.when(F.col("__r") <= n_test, "test").otherwise("train")) \
        .drop("__h", "__r", "__n", "__lab")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = FOLDS, seed: int = SEED,
                     exact: bool = True, fold_col: str = "fold") -> DataFrame:
    """H9: fold = (position in class − 1) mod k — folds partition the rows and
    differ in size by at most one per class."""
    if not exact:
        h = F.conv(F.substring(shuffle_key(key, seed), 1, 8), 16, 10).cast("bigint")
        return df.withColumn(fold_col, (h % k).cast("int"))
    ranked = _ranked(df, label, key, seed)
    return ranked.withColumn(fold_col, ((F.col("__r") - 1) % k).cast("int")).drop("__h", "__r")
