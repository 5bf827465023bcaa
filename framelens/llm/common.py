"""What the corpus operators share: durable intermediate tables, stable keys and global order.

Rules that hold for every operator of this package:

* a null text counts as the empty text;
* a null id is an id of its own that sorts before all others;
* rows that repeat an id are rows of their own and are never multiplied by a join;
* an extra column of the input is never read, whatever its name.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Stands for a null id where ids are ordered as integers.
NULL_ID = -(2**63)

_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Without that setting a local session has a temporary one; a cluster has
    none that its executors share, so there this raises an error."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="framelens-")
        spark.sparkContext.setCheckpointDir(_own_dirs[app])
    return _own_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark)}/framelens/{label}-{uuid.uuid4().hex}"
    store, place = _file_system(spark, path), spark._jvm.org.apache.hadoop.fs.Path(path)
    store.deleteOnExit(place)
    whole = store.makeQualified(place).toString()
    # The form of a local address that both Spark's and Arrow's file systems read.
    return whole.replace("file:/", "file:///", 1) if whole.startswith("file:/") and not whole.startswith("file://") else whole


def _file_system(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


#: Rows that are whole texts which Python takes at a time, and the setting of how many the JVM sends.
TEXT_ROWS, BATCH_KEY = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of whole texts in slices, so that few of them are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, TEXT_ROWS):
            yield batch.slice(at, TEXT_ROWS)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Smaller Arrow batches while a block runs; the session is then as it was."""
    before = int(spark.conf.get(BATCH_KEY))
    spark.conf.set(BATCH_KEY, str(min(before, TEXT_ROWS) if before > 0 else TEXT_ROWS))
    try:
        yield
    finally:
        spark.conf.set(BATCH_KEY, str(before))


def stored(df: DataFrame, label: str, texts: bool = False) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and reads it back: cuts the lineage, survives lost executors.

    ``texts`` says that its plan hands whole texts to Python, which it then does in smaller batches: one stands in the
    JVM and in Python at once, so its size is most of what such a task holds.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with small_batches(spark) if texts else nullcontext():
        df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._framelens_path = path
    return back


def drop_stored(df: DataFrame) -> None:
    """Deletes the files of a table made by :func:`stored` that nothing will read again."""
    path = df._framelens_path
    _file_system(df.sparkSession, path).delete(df.sparkSession._jvm.org.apache.hadoop.fs.Path(path), True)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or that with underscores behind it, so that ``df`` has no such column in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once for a row: lambdas would compute it again for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def sample_cut(keys: DataFrame, hash_col: str, most: int) -> int | None:
    """The largest of the ``most`` smallest distinct values of a column of 64-bit hashes; null without values.

    Only values under a bound that leaves a few more than wanted are sorted, so what meets in a task depends on ``most``
    and not on the number of rows or splits.
    """
    n = keys.agg(F.approx_count_distinct(hash_col)).first()[0]
    share = 1.25 * most / n if n else 1.0
    while True:
        low = keys.where(F.col(hash_col) < F.lit(int(share * 2**64) - 2**63)) if share < 1 else keys
        found = low.select(hash_col).distinct().orderBy(hash_col).limit(most).agg(F.count("*").alias("n"), F.max(hash_col).alias("cut")).first()
        if share >= 1 or found["n"] == most:
            return found["cut"]
        share *= 2


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def order_id(name: str = "doc_id") -> Column:
    """The id as a never-null integer, a null before all others."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_ID))


def ranged(df: DataFrame, *keys: str, label: str = "ranged") -> DataFrame:
    """``df`` dealt out by ranges of ``keys`` and stored, with the number of its range in ``_range``.

    The ranges are as many as the shuffle partitions, so a table with a row for each is small by configuration.
    """
    n = shuffle_partitions(df.sparkSession)
    return stored(df.repartitionByRange(n, *keys).withColumn("_range", F.spark_partition_id()), label)


def running_total(df: DataFrame, value: str, *keys: str, into: str = "before") -> DataFrame:
    """Adds the sum of ``value`` over all rows before each row in the order of ``keys``.

    Two levels: a window in each range, and one over the totals of the ranges. No task sees more than a range.
    """
    parts = ranged(df, *keys)
    totals = parts.groupBy("_range").agg(F.sum(value).alias("_total"))
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_range", F.coalesce(F.sum("_total").over(ahead), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    # A row for each range: bounded by the number of shuffle partitions.
    return (
        parts.join(F.broadcast(bases), "_range")
        .withColumn(into, F.col("_base") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_range", "_base")
    )
