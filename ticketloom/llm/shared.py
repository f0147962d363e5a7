"""Intermediate results that survive lost executors, and small helpers of the operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.session import discarded, drop_finished, shared_path

# Bits of a filter: for each key, in a piece, and at most (32 MB).
BITS_PER_KEY, PIECE, MOST_BITS = 32, 1 << 15, 1 << 28
FILE_ROWS = 1 << 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """The rows, written once to the cluster's shared folder and read from there.

    Right after a step Spark's listeners may still hold its plan, and with it its shuffle
    files; so garbage is collected before the next one, too.
    """
    spark = df.sparkSession
    path = path or shared_path(spark, name)
    drop_finished(spark)
    df.write.parquet(path)
    drop_finished(spark)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder for intermediate tables, removed at the end with all that lies in it."""
    path = shared_path(spark, "scratch")
    try:
        yield path
    finally:
        discarded(spark, path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage; the checkpoint folder is set here only where the session has none."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_path(df.sparkSession, "checkpoint"))
    return df.checkpoint()


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any spelling."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the number ``name`` of each row, the same whenever it is read: a copy is written."""
    return saved(docs.withColumn(name, F.monotonically_increasing_id()), "numbered-rows")


def numbered_in_files(docs: DataFrame, name: str) -> DataFrame:
    """The same for rows of Parquet files, each as it lies there and once: they are numbered by file
    and place, so no copy is written. Other rows are ``numbered``."""
    path, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    try:
        found = docs.select("*", path.alias("__file"), place.alias("__place"))
    except AnalysisException:
        return numbered(docs, name)
    files = sorted(r[0] for r in docs.select(path.alias("file")).distinct().collect())
    of = docs.sparkSession.createDataFrame(list(enumerate(files)), "__number bigint, __path string")
    row = F.col("__number") * FILE_ROWS + F.col("__place")
    return found.join(F.broadcast(of), F.col("__file") == F.col("__path")).select(*docs.columns, row.alias(name))


def marked(df: DataFrame, wanted: DataFrame, key: list[str], mark: str) -> DataFrame:
    """``df`` with ``mark``: whether the key of a row may be among those of ``wanted``.

    It is true for all that are and for few others. What is sent to the tasks is a bitmap of
    hashed keys, of bounded size; so rows can be told apart before they are shuffled.
    """
    bits, n = PIECE, wanted.count()
    while bits < min(n * BITS_PER_KEY, MOST_BITS):
        bits *= 2
    slot = F.pmod(F.xxhash64(*key), F.lit(bits))
    piece, place = F.shiftright(slot, 15), F.pmod(slot, F.lit(PIECE))
    # Slots are dealt by piece, not combined before: a piece is larger than what a task has of it.
    dealt = wanted.select(piece.alias("__piece"), place.alias("__place")).distinct().repartition("__piece")
    pieces = checkpointed(dealt.groupBy("__piece").agg(F.bitmap_construct_agg("__place").alias("__bits")))
    byte = F.substring("__bits", F.shiftright(place, 3).cast("int") + 1, F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(place, F.lit(8)).cast("int"))
    found = df.withColumn("__of", piece).join(F.broadcast(pieces), F.col("__of") == F.col("__piece"), "left")
    return found.select(*df.columns, F.coalesce(bit == 1, F.lit(False)).alias(mark))


def narrowed(df: DataFrame, wanted: DataFrame, *key: str) -> DataFrame:
    """The rows of ``df`` whose key may be among those of ``wanted``: all that are, and few others."""
    return marked(df, wanted, list(key), "__may").where("__may").drop("__may")


def without(df: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose key is not in ``gone``, a written table; the others, and few more, are shuffled."""
    may = free_name(df, "may_go")
    rows = marked(df, gone, [key], may)
    return rows.where(~F.col(may)).unionAll(rows.where(may).join(gone.select(key), key, "left_anti").select(*rows.columns)).drop(may)
