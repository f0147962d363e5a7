"""Join shapes that stay balanced when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_KEY = "__join_key"
_HOT_KEY = "__hot_key"
_SHARES = "__shares"

ROWS_PER_SHARE = 1_000_000
# What a task that sorts or hashes whole rows is given, whatever the input.
ROWS_PER_TASK = 500_000
# So many hot keys a shuffle partition are listed at most; see ``hot_keys`` why no more are needed.
HOT_PER_PARTITION = 4


def spread(df: DataFrame, rows: int, *keys: str, rows_per_task: int | None = None) -> DataFrame:
    """``df``, of about so many ``rows``, with the rows of a key together, in more partitions than
    the session has if a task would hold more than ``ROWS_PER_TASK`` of them otherwise.

    A grouping or window by these keys then needs no other shuffle. Smaller tables are left
    as they are, so adaptive execution may merge their partitions.
    """
    partitions = -(-rows // (rows_per_task or ROWS_PER_TASK))
    if partitions <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(partitions, *keys)


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """The non-null keys of ``df`` once each; combined map-side, so a hot key is one row
    per map task by the time it is shuffled."""
    return df.select(F.col(key).alias(_KEY)).where(F.col(_KEY).isNotNull()).distinct()


def without_match(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``left`` whose key is NULL or absent from ``right``.

    NULL keys stay where they lie; in the join they would all meet in one task.
    """
    keys = distinct_keys(right, right_key)
    keyed = left.where(F.col(left_key).isNotNull())
    return keyed.join(keys, F.col(left_key) == F.col(_KEY), "left_anti").unionAll(
        left.where(F.col(left_key).isNull())
    )


def hot_keys(df: DataFrame, key: str, rows_per_share: int) -> DataFrame:
    """The keys that need splitting, and how many shares each needs.

    Those that hold ``rows_per_share`` rows, the largest ``HOT_PER_PARTITION`` a shuffle
    partition. A key that is not among so many holds less than a quarter of what an even
    partition holds, whatever the keys, so it needs no splitting; and the list is short
    enough to be broadcast. Counts are combined map-side.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias(_HOT_KEY))
        .agg(F.count("*").alias("__n"))
        .where(F.col("__n") >= rows_per_share)
        .orderBy(F.desc("__n"), _HOT_KEY)
        .limit(HOT_PER_PARTITION * partitions)
        .select(_HOT_KEY, F.ceil(F.col("__n") / rows_per_share).cast("int").alias(_SHARES))
    )


def _deal(many: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Give each row a share: 0, or for a hot key one of the key's shares.

    Shares follow from the row's content, and from the number of the task that reads it so
    that copies of one and the same row are spread as well.
    """
    row = [f.name for f in many.schema if "map<" not in f.dataType.simpleString()]
    share = F.pmod(F.xxhash64(*row, F.spark_partition_id()), F.col(_SHARES)).cast("int")
    return (
        many.join(hot, F.col(key) == F.col(_HOT_KEY), "left")
        .withColumn("__dealt_share", F.coalesce(share, F.lit(0)))
        .drop(_HOT_KEY, _SHARES)
    )


def dealt(many: DataFrame, key: str, rows_per_share: int = ROWS_PER_SHARE) -> tuple[DataFrame, str]:
    """``many`` with a share for each row, 0 unless its key is hot, and the name of that column."""
    return _deal(many, key, F.broadcast(hot_keys(many, key, rows_per_share))), "__dealt_share"


def _repeat(one: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Repeat the row of a hot key once per share; other rows occur once, with share 0."""
    shares = F.sequence(F.lit(0), F.coalesce(F.col(_SHARES) - 1, F.lit(0)))
    return one.join(hot, F.col(key) == F.col(_HOT_KEY), "left").withColumn(
        "__share", F.explode(shares)
    )


def _check_columns(left: DataFrame, right: DataFrame) -> None:
    shared = set(left.columns) & set(right.columns)
    if shared:
        raise ValueError(f"columns on both sides of the join: {sorted(shared)}")


def left_join_to_many(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    rows_per_share: int = ROWS_PER_SHARE,
) -> DataFrame:
    """Left outer join for a ``right`` side in which one key may hold a huge share.

    Adaptive execution splits a skewed partition only on the preserved side of an outer
    join, so all right rows of a hot key would meet in one task. Here the rows of a hot
    key are dealt into shares, and the left row of a hot key is repeated once per share.
    A hot key has right rows by definition, so a repeated left row that found its share
    empty is dropped; any other left row occurs once and keeps the outer join's meaning.
    Left rows with a NULL key match nothing and are added where they lie: in the join they
    would all meet in one task.
    """
    _check_columns(left, right)
    hot = F.broadcast(hot_keys(right, right_key, rows_per_share))
    same_key = F.col(left_key) == F.col(right_key)
    joined = (
        _repeat(left.where(F.col(left_key).isNotNull()), left_key, hot)
        .join(
            _deal(right, right_key, hot),
            same_key & (F.col("__share") == F.col("__dealt_share")),
            "left",
        )
        .where(F.col(_SHARES).isNull() | F.col(right_key).isNotNull())
        .select(*left.columns, *right.columns)
    )
    absent = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in right.columns]
    return joined.unionByName(left.where(F.col(left_key).isNull()).select("*", *absent))


def join_many_to_one(
    many: DataFrame,
    one: DataFrame,
    many_key: str,
    one_key: str,
    how: str = "inner",
    rows_per_share: int = ROWS_PER_SHARE,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Inner, left, semi or anti join of ``many``, in which one key may hold a huge share,
    with ``one``, which has a row per key.

    Adaptive execution splits a skewed partition only where both join sides come straight
    from a shuffle, which an aggregated ``one`` does not. So the rows of the hot keys meet
    those keys' rows of ``one`` (as few as there are hot keys) in a broadcast join, where
    they lie; the others are joined as usual and ``one`` keeps its partitioning. Without
    hot keys adaptive execution removes the first branch. Rows with a NULL key match
    nothing; where the join keeps them they are added unshuffled. ``one`` must have a
    row per key: copies would be broadcast as well. ``counted`` is where hot keys are
    looked for, if something with ``many``'s keys is cheaper to read than ``many``.
    """
    _check_columns(many, one)
    counted = many if counted is None else counted
    hot = F.broadcast(hot_keys(counted, many_key, rows_per_share).select(_HOT_KEY))
    same_key = F.col(many_key) == F.col(one_key)
    is_hot = F.col(many_key) == F.col(_HOT_KEY)
    # An inner join, because a semi join would be moved below an aggregation in ``one``
    # and have its input read a second time.
    hot_one = one.join(hot, F.col(one_key) == F.col(_HOT_KEY), "inner").drop(_HOT_KEY)
    keyed = many.where(F.col(many_key).isNotNull())
    joined = (
        keyed.join(hot, is_hot, "left_semi")
        .join(F.broadcast(hot_one), same_key, how)
        .unionByName(keyed.join(hot, is_hot, "left_anti").join(one, same_key, how))
    )
    if how not in ("left", "left_anti"):
        return joined
    absent = [F.lit(None).cast(joined.schema[c].dataType).alias(c) for c in joined.columns if c not in many.columns]
    return joined.unionByName(many.where(F.col(many_key).isNull()).select("*", *absent))
