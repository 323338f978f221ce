"""Helpers shared by the operators: scratch tables, checked broadcasts, skew-safe lookups."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import operator
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, StringType, StructType

#: A side is broadcast only if its measured bytes stay under this.
BROADCAST_BYTES = 64 << 20
#: A key counts as hot when it holds more than this share of the rows; at most
#: ``1 / HOT_SHARE`` keys can be hot, which bounds the broadcast of hot keys.
HOT_SHARE = 0.001
#: Rows below which no key is hot.
HOT_LEAST = 64

#: Rows of an Arrow batch at most.
BATCH_ROWS = 2000
#: Bytes of an Arrow batch at most (a longer row stands alone).
BATCH_BYTES = 8 << 20

_left_over: list[tuple[SparkSession, str]] = []


def _scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the session; a temporary one only in local mode and where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    set_before = context.getCheckpointDir()
    if set_before:
        return set_before.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="shotlake-scratch-")
    atexit.register(shutil.rmtree, local, True)
    context.setCheckpointDir(local)
    return context.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new place in the shared scratch folder, deleted when the process ends."""
    path = f"{_scratch_root(spark)}/shotlake/{tag}-{uuid.uuid4().hex}"
    if not _left_over:
        atexit.register(clean_up)
    _left_over.append((spark, path))
    return path


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts lineage and survives lost executors: later stages read files, not blocks.
    """
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def written() -> int:
    """The number of scratch places there are, for ``discard``."""
    return len(_left_over)


def discard(begin: int, *kept: str) -> None:
    """Delete the scratch tables written after the first ``begin``, but for those with the tags ``kept``.

    For tables that nothing reads any more, as what is made from them has been written.
    """
    some = [(spark, path, path.rpartition("/")[2].rpartition("-")[0] in kept) for spark, path in _left_over[begin:]]
    _left_over[begin:] = [(spark, path) for spark, path, stays in some if stays]
    for spark, path, stays in some:
        if not stays:
            delete(spark, path)


def clean_up() -> None:
    """Delete the scratch tables written so far by this process."""
    while _left_over:
        try:
            delete(*_left_over.pop())
        except Exception:  # the session may be gone; the shared folder is temporary anyway
            return


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def fenced(df: DataFrame, condition: str) -> DataFrame:
    """``df`` filtered, without the optimizer copying the definitions of its columns into the filter.

    Computed columns with long definitions would otherwise be computed twice or, in
    lambdas, once per element; a filter is not moved below a numbering of rows.
    """
    return df.withColumn("_fence", F.monotonically_increasing_id()).filter(F.expr(condition) & (F.col("_fence") >= 0)).drop("_fence")


def shielded(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``operator``, from documents to documents, made safe for any further columns.

    They go through it under plain names; one that the operator makes itself is replaced.
    """

    @functools.wraps(operator)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        names = {f"own_{i}": c for i, c in enumerate(docs.columns) if c.lower() not in ("doc_id", "text")}
        plain = {c: k for k, c in names.items()}
        found = operator(docs.toDF(*[plain.get(c, c) for c in docs.columns]), *args, **options)
        made = {c.lower() for c in found.columns if c not in names}
        found = found.drop(*[k for k, c in names.items() if c.lower() in made])
        return found.toDF(*[names.get(c, c) for c in found.columns])

    return run


def _width(column: Column, kind: DataType) -> Column:
    """Bytes that a value takes in a row, with its place there."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("bigint") + 16
    if isinstance(kind, StructType):
        return functools.reduce(operator.add, [_width(column[f.name], f.dataType) for f in kind.fields], F.lit(24))
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, (StringType, BinaryType)):
        return F.aggregate(column, F.lit(32).cast("bigint"), lambda a, x: a + _width(x, kind.elementType))
    if isinstance(kind, ArrayType):  # elements of one width
        fields = len(kind.elementType.fields) if isinstance(kind.elementType, StructType) else 0
        return F.greatest(F.size(column), F.lit(0)).cast("bigint") * (24 + 8 * fields if fields else 8) + 32
    return F.lit(8)


def measured_bytes(df: DataFrame) -> int:
    """Bytes that the rows of ``df`` take in a broadcast table (``df`` has to be cheap to read)."""
    each = functools.reduce(operator.add, [F.coalesce(_width(F.col(f"`{f.name}`"), f.dataType).cast("bigint"), F.lit(16).cast("bigint")) for f in df.schema.fields], F.lit(32).cast("bigint"))
    return df.agg(F.sum(each)).first()[0] or 0


def fits(df: DataFrame, bound: int = BROADCAST_BYTES) -> bool:
    """Whether the measured bytes of ``df`` may be broadcast."""
    return measured_bytes(df) <= bound


def small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if its measured bytes allow, else unchanged."""
    return F.broadcast(df) if fits(df) else df


def lookup(facts: DataFrame, dim: DataFrame, keys: list[str], weight: str, how: str = "inner") -> DataFrame:
    """Join ``facts`` with ``dim`` (one row per key) without a hot shuffle partition.

    ``weight`` is a column of ``dim`` saying how many fact rows have the key.  The
    few keys above ``HOT_SHARE`` of all rows are broadcast (at most ``1/HOT_SHARE``
    of them); every other key is joined by shuffle, and all are where none is hot.
    Keys are never null.  ``dim`` has to be materialised: it is read three times.
    """
    total, most = (x or 0 for x in dim.agg(F.sum(weight), F.max(weight)).first())
    least = max(HOT_LEAST, int(total * HOT_SHARE))
    if most <= least:
        return facts.join(dim, keys, how)
    hot, cold = dim.filter(F.col(weight) > least), dim.filter(F.col(weight) <= least)
    marks = F.broadcast(hot.select(*keys).withColumn("_hot", F.lit(True)))
    marked = facts.join(marks, keys, "left")
    in_hot = marked.filter("_hot").drop("_hot").join(F.broadcast(hot), keys)
    in_cold = marked.filter("_hot is null").drop("_hot").join(cold, keys, how)
    return in_hot.unionByName(in_cold)


def arrow_map(df: DataFrame, function: Callable[[pa.RecordBatch], dict | None], schema: str) -> DataFrame:
    """``mapInArrow`` with a function from a batch to columns (lists or arrays) by name."""
    from pyspark.sql.pandas.types import to_arrow_schema

    bounded_batches(df.sparkSession)
    out = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = function(batch)
                if columns is not None:
                    yield pa.RecordBatch.from_arrays([_array(columns[f.name], f.type) for f in out], schema=out)
        release()

    return df.mapInArrow(run, schema)


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's rows and bytes per Arrow batch, as a worker holds several copies of a batch's texts."""
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(rows)) > BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    now = spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(size, f"{BATCH_BYTES}b")


def release() -> None:
    """Give freed memory back at the end of a task, as a worker goes on to other tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not on every platform
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def utf8(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8 bytes; null counts as empty."""
    column = batch.column(name)
    column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    return [x or b"" for x in column.to_pylist()]
