"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: ASCII white space, 0x20 and 0x09 to 0x0D: what separates words.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"

#: The columns of ``documents``; pipeline stages return exactly these.
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read
    back: cuts the lineage, survives lost executors, visible to all of them."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts_for(df: DataFrame, rows: int, rows_per_task: int) -> int:
    """Partitions so that none holds many more than ``rows_per_task`` rows,
    at least the session's shuffle setting."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(rows / rows_per_task))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row: bound to a lambda
    variable, so the optimizer cannot copy it to each place of use."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_or_empty(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, as an array."""
    return let(
        F.trim(text, F.lit(SPACES)),
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RUN)),
    )


def by_bytes(batches: Iterator[pa.RecordBatch], column: int, rows: int, size: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of at most ``rows`` rows whose texts in ``column``
    take no more than ``size`` bytes together, or of a single row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            stop = min(at + rows, max(at + 1, int(np.searchsorted(ends, before + size, "right"))))
            yield batch.slice(at, stop - at)
            at = stop


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI as tasks open it, and the path there.
    The folder must be one that all workers share."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


#: Rows that Spark hands to a Python worker at a time. Texts can be long, and
#: the batch is held outside of the heap.
ARROW_ROWS = 1_000


def prepare_session(spark: SparkSession) -> None:
    """What a job with Python in its tasks needs of its session: this package
    on the workers, so that it also runs where they cannot import it by
    themselves, and Arrow batches of bounded size. The queries and the pipeline
    call it; the operators leave the session as it is."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, ARROW_ROWS)
    sc = spark.sparkContext
    if getattr(sc, "_souk_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="souk-package-")  # the driver's; Spark serves it to the workers
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._souk_shipped = True
