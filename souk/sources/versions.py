"""Versioned month partitions: where mergeable states are kept between runs.

A run writes the months it touches as new partitions beside the old ones
(``<table>/run=<run>/year_month=<month>``) and never writes what it reads. What
counts is told by the last commit, a small file that names the run of each
table's month; until it is there a reader sees the state before, whatever a
broken run left behind. A run that is started again overwrites its own
partitions only, and a batch that is committed isn't applied twice.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.state import MONTH, State
from . import io

_COMMIT = "kind string, name string, year_month string, run string, rows long"
_RUN = T.StructField("run", T.StringType())
#: Folder name of a null month.
NULL_MONTH = "__HIVE_DEFAULT_PARTITION__"


class Versions:
    """States and immutable line tables under one folder. The commit held
    here has one row per table and month, and one per batch."""

    def __init__(self, spark: SparkSession, base: str, fresh: bool = False):
        """``fresh``: start from nothing; the old commit stays until the next."""
        self.spark, self.base = spark, base.rstrip("/")
        self.number = max(self._commits(), default=0)
        self.runs: dict[tuple[str, str | None], str] = {}
        self.batches: dict[str, int] = {}
        self.lines: dict[str, list[str]] = {}
        self.schemas: dict[str, T.StructType] = {}
        if self.number and not fresh:
            for r in spark.read.schema(_COMMIT).parquet(self._commit_path(self.number)).collect():
                if r.kind == "month":
                    self.runs[r.name, r.year_month] = r.run
                elif r.kind == "lines":
                    self.lines.setdefault(r.name, []).append(r.run)
                else:
                    self.batches[r.name] = r.rows

    def _commit_path(self, number: int) -> str:
        return f"{self.base}/commits/{number:08d}"

    def _commits(self) -> list[int]:
        """Numbers of the commits whose write was finished."""
        names = [p.getName() for p in io.children(self.spark, f"{self.base}/commits")]
        return [int(n) for n in names if io.exists(self.spark, f"{self.base}/commits/{n}/_SUCCESS")]

    def path(self, name: str, run: str) -> str:
        return f"{self.base}/{name}/run={run}"

    def read(self, name: str, schema: T.StructType, months: Iterable[str | None] | None = None) -> DataFrame:
        """The current state, of some ``months`` or all. Prunes partitions."""
        wanted = set(self._months(name) if months is None else months)
        own = [f"{run}/{m or ''}" for (n, m), run in self.runs.items() if n == name and m in wanted]
        if not own:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(T.StructType([*schema.fields, _RUN])).parquet(f"{self.base}/{name}")
        version = F.concat("run", F.lit("/"), F.coalesce(MONTH, F.lit("")))
        return rows.where(version.isin(own)).select(*schema.names)

    def _months(self, name: str) -> list[str | None]:
        return [m for n, m in self.runs if n == name]

    def add(self, name: str, state: State, rows: DataFrame, months: Iterable[str | None], run: str, replace: bool = False) -> None:
        """Merges ``rows`` into a state, or (``replace``) puts them in place of
        their ``months``. Seen by this object at once, by others once committed."""
        months = list(months)
        new = state.of(rows)
        self.schemas[name] = new.schema
        if not replace and any((name, m) in self.runs for m in months):
            new = state.merged(self.read(name, new.schema, months), state.each(rows))
        io.write_table(io.clustered_for_write(new, [MONTH]), self.path(name, run), partition_by=[MONTH])
        self.runs |= {(name, m): run for m in months}

    def state(self, name: str, state: State, like: DataFrame) -> DataFrame:
        """The current state; ``like``: rows it could be made from."""
        return self.read(name, self.schemas.get(name) or state.of(like).schema)

    def add_lines(self, name: str, rows: DataFrame, run: str, partition_by: Iterable[str] = ()) -> None:
        """Rows kept as they are, a folder a run."""
        io.write_table(rows, self.path(name, run), partition_by=list(partition_by))
        self.lines[name] = [*(r for r in self.lines.get(name, []) if r != run), run]

    def read_lines(self, name: str, *runs: str) -> DataFrame:
        """The rows of these runs, or of all current ones."""
        paths = [self.path(name, r) for r in runs or self.lines[name]]
        return self.spark.read.option("basePath", f"{self.base}/{name}").parquet(*paths).drop("run")

    def commit(self, batch: str, rows: int) -> None:
        self.batches[batch] = rows
        table = [("month", n, m, run, None) for (n, m), run in self.runs.items()]
        table += [("lines", n, None, run, None) for n, own in self.lines.items() for run in own]
        table += [("batch", b, None, None, n) for b, n in self.batches.items()]
        self.number += 1
        io.write_table(self.spark.createDataFrame(table, _COMMIT).coalesce(1), self._commit_path(self.number))

    def mark(self, what: str) -> None:
        """Notes that ``what`` was made from the last commit."""
        done = self.spark.createDataFrame([(what,)], "made string").coalesce(1)
        io.write_table(done, f"{self.base}/marks/{what}-{self.number:08d}")

    def marked(self, what: str) -> bool:
        return io.exists(self.spark, f"{self.base}/marks/{what}-{self.number:08d}/_SUCCESS")

    def vacuum(self) -> None:
        """Deletes the partitions that the last commit doesn't name. Not while
        another reader may still use an older one."""
        for name in {n for n, _ in self.runs}:
            own = {f"run={run}/{MONTH}={NULL_MONTH if m is None else m}" for (n, m), run in self.runs.items() if n == name}
            for run in io.children(self.spark, f"{self.base}/{name}"):
                for part in io.children(self.spark, run.toString()):
                    if part.getName().startswith(MONTH) and f"{run.getName()}/{part.getName()}" not in own:
                        io.delete(self.spark, part.toString())
