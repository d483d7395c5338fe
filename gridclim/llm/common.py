"""What several of the text operators share: a scratch folder that all executors see, and slices of batches."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are worked on in slices of about so many characters, which bounds the memory of a task.
SLICE_CHARS = 1_000_000
#: Rows that Spark hands to Python at once, unless the session has its own setting: rows of text are long.
BATCH_ROWS = 1_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Set the session's batch size for long rows, where the user has set none."""
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names. On one machine, where it may be unset (tests), a temporary one is set;
    on a cluster it must be set, as executors don't share a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not found:
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoints-"))
        found = sc._jsc.sc().getCheckpointDir().get()
    elif sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of the scratch space, wherever that lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    try:
        delete(spark, path)
    except Exception:  # noqa: BLE001  the session may be gone already
        pass


def stage(df: DataFrame, name: str, *partitions: str) -> tuple[DataFrame, str]:
    """Write df as Parquet into the scratch space and read it again, which cuts the lineage: a lost executor
    costs no work before this point. The folder goes when the program ends, or earlier by delete()."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
    atexit.register(_delete_at_exit, spark, path)
    return spark.read.schema(df.schema).parquet(path), path


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo: which fold a document is in."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def texts(pdf: pd.DataFrame, column: str = "text") -> list[str]:
    """The column's texts; null is an empty text."""
    return [x if isinstance(x, str) else "" for x in pdf[column]]


def slices(items: list, most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of the list whose lengths sum to about `most`; a longer item stands alone."""
    return _ranges([len(x) for x in items], most)


def _ranges(lengths: list[int], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    start = held = 0
    for i, n in enumerate(lengths):
        if held and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(lengths):
        yield start, len(lengths)


def segment_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of values[start:end] for each pair, empty ranges included."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), np.float64), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[ends] - total[starts]


#: Types that map_texts() can add.
_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}


def map_texts(
    docs: DataFrame, make: Callable, added: dict[str, str], column: str = "text", inputs: tuple[str, ...] = (), done: Callable[[], None] | None = None
) -> DataFrame:
    """Apply make() to slices of the texts, inside tasks; null is an empty text.

    make(texts, *inputs) returns the added columns in order, or a tuple (indices, columns) where one document gives
    any number of rows: indices say which text each row comes from. Other columns pass through as they are; where
    one has the name of an added column, the added one takes its place. `inputs` are handed to make() and dropped.
    done() is called when a task has no more texts: Python processes outlive tasks, and so does what they remember.
    """
    small_batches(docs.sparkSession)
    kept = [f for f in docs.schema if f.name not in {column, *added, *inputs}]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(column)
            for a, b in _ranges(pc.fill_null(pc.binary_length(found), 0).to_pylist()):
                made = make([x or "" for x in found[a:b].to_pylist()], *(batch.column(x)[a:b].to_pylist() for x in inputs))
                rest = batch.select([f.name for f in kept]).slice(a, b - a)
                if isinstance(made, tuple):
                    at, made = made
                    rest = rest.take(pa.array(at, pa.int64()))
                new = [pa.array(v, _ARROW[t]) for v, t in zip(made, added.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([*rest.columns, *new], [*rest.schema.names, *added])
        if done is not None:
            done()

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"{n} {t}" for n, t in added.items())])
    return docs.select(*(f.name for f in kept), column, *inputs).mapInArrow(apply, schema)
