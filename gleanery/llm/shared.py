"""What the operators of this subpackage share: the shared folder, written tables, ranges of ids and skew-proof joins."""

from __future__ import annotations

import atexit
import bisect
import ctypes
import gc
import os
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

from gleanery import shipping

#: A key is hot if it holds over one in HOT_SHARE rows, so that at most HOT_SHARE keys are hot and may be broadcast.
HOT_SHARE = 4096
_ROOTS: dict[str, str] = {}

#: Bytes of a batch that goes to a Python worker, where the session does not say otherwise: a batch of texts is held in the JVM, in
#: the worker's buffers and as Python strings, so that large ones cost several times their size.
BATCH_BYTES = 2 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers of any cluster, once for each application, and keep batches small."""
    if spark.conf.get(_BATCH) in ("64MB", f"{64 << 20}b", str(64 << 20)):
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    shipping.ship(spark)


def release() -> None:
    """Give the memory that this process has freed back to the system: a worker lives on after its task, beside the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


#: What operators remember in a worker from task to task, by module: its forget() drops it and tells whether there was any.
_REMEMBERING = ("gleanery.llm.tokenizing", "gleanery.llm.secret_scan")


def lean(of_batches: Callable, own: str = "") -> Callable:
    """of_batches, in a worker that forgets before what earlier operators' tasks have left in it, but for what the module own remembers,
    and gives back its own memory after."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if any([sys.modules[m].forget() for m in _REMEMBERING if m != own and m in sys.modules]):
            gc.collect()  # an encoder and its pieces hold each other
            release()
        try:
            yield from of_batches(batches)
        finally:
            release()

    return run


def lean_column(function: Callable, kind: str, own: str = "") -> Callable:
    """A column of function of each row's values, the first of which is a text (or null), in a lean worker. It goes by Arrow, so that no
    worker loads pandas, and few texts at a time are Python strings."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [pa.array([function(*row) for row in zip(*(c.to_pylist() for c in part.columns), strict=True)], _ARROW[kind]) for part in slices([batch], "0", most=1 << 20)]
            yield pa.concat_arrays(parts) if parts else pa.array([], _ARROW[kind])

    leaned = lean(each, own)

    def run(columns):
        together = (c if isinstance(c, tuple) else (c,) for c in columns)
        return leaned(pa.RecordBatch.from_arrays(list(c), [str(k) for k in range(len(c))]) for c in together)

    return F.arrow_udf(run, kind, ArrowUDFType.SCALAR_ITER)


def shared_root(spark: SparkSession) -> str:
    """A folder of this application under spark.checkpoint.dir, as a URI.

    Only a local master may go without that setting; it then gets a temporary folder, and the setting of the context.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _ROOTS:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            base = "file://" + tempfile.mkdtemp(prefix="gleanery-shared-")
            sc.setCheckpointDir(base)
        if "://" not in base:
            base = "file://" + os.path.abspath(base.removeprefix("file:"))
        root = f"{base.rstrip('/')}/gleanery-{uuid.uuid4().hex}"
        _ROOTS[sc.applicationId] = root
        atexit.register(_remove, spark, root)
    return _ROOTS[sc.applicationId]


def _remove(spark: SparkSession, uri: str) -> None:
    try:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the application has ended; its folder goes with the cluster's own clean-up
        return


def fresh(spark: SparkSession, name: str) -> str:
    """A path of the shared folder that nothing has used yet."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read back: its lineage ends there, and losing an executor costs nothing."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def long_id(df: DataFrame, column: str) -> Column:
    """The id as a long that sorts; a null id sorts first."""
    return F.coalesce(df[column].cast("long"), F.lit(-(2**63)))


class Ranges:
    """Ranges of ids with about as many rows each, from quantiles over all rows.

    The driver holds a bound for each range and nothing else.
    """

    def __init__(self, ids: DataFrame, column: str, n: int):
        probabilities = [i / n for i in range(1, n)]
        found = ids.stat.approxQuantile(column, probabilities, min(0.01, 0.2 / n)) if n > 1 else []
        self.bounds = sorted({int(x) for x in found})

    def __len__(self) -> int:
        return len(self.bounds) + 1

    def of(self, column: Column) -> Column:
        bounds = self.bounds

        @F.pandas_udf("int")
        def range_of(ids):
            import numpy as np

            return ids.__class__(np.searchsorted(np.array(bounds, dtype=np.int64), ids.to_numpy(dtype=np.int64), side="right").astype("int32"))

        return range_of(column)

    def at(self, value: int) -> int:
        return bisect.bisect_right(self.bounds, value)


def join_groups(rows: DataFrame, groups: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Left join of rows to one row for each key, where a key may hold any share of the rows.

    count: the column of groups with the number of rows of its key. Keys with over total / HOT_SHARE rows are HOT_SHARE
    at most; they are broadcast and their rows aren't moved. The others are joined by a shuffle, in which no key is hot.
    """
    hot = F.broadcast(groups.where(F.col(count) * HOT_SHARE > total))
    cold = groups.where(F.col(count) * HOT_SHARE <= total)
    return rows.join(hot, key).unionByName(rows.join(hot, key, "left_anti").join(cold, key, "left"), allowMissingColumns=True)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20, rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with few bytes in the named column, so that a batch of long texts needs no more memory."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = 0
        while start < batch.num_rows:
            end, size = start, 0
            while end < batch.num_rows and end - start < rows and (end == start or size + sizes[end] <= most):
                size += int(sizes[end])
                end += 1
            yield batch.slice(start, end - start)
            start = end


def whole_groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """The rows of the batches, which come in order of a long column, in tables of whole groups; holds a group between batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column).to_numpy()
        others = (values != values[-1]).nonzero()[0]
        cut = int(others[-1]) + 1 if len(others) else 0
        if held and (cut or held[-1].column(column)[-1].as_py() != values[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a slice; a null is an empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}


def schema_of(ddl: str) -> pa.Schema:
    """The Arrow schema of a DDL string of plain columns and arrays of them, without a session."""
    columns = [c.split() for c in ddl.split(",")]
    return pa.schema([(name, pa.list_(_ARROW[kind[6:-1]]) if kind.startswith("array<") else _ARROW[kind]) for name, kind in columns])
