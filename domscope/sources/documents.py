"""Documents: single files in a fixed order that people read, of any size, on any store that Spark writes.

A document is made of text and of tables. Spark sorts a table and writes its rows, each as it stands in
the document, in parts; then the parts are copied behind one another, byte for byte, under a name of their
own, and the file takes its place when it is whole. Nothing is collected, a failed write leaves the file
that was there, and the rows are counted as they are written (``Rows.counts``).
"""

from __future__ import annotations

import csv
import io
import json
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .shared import shared_dir


@dataclass
class Rows:
    """A table in a document, in the order of ``order`` (columns that are not written). ``sparse``: structs
    that leave out their nulls; ``parsed``: columns of JSON text; ``only``: the one column whose values
    stand for the rows; ``metrics``: aggregates over the rows, which ``counts`` has after the write, beside
    ``rows``."""

    table: DataFrame
    order: Sequence[str | Column] = ()
    drop: Sequence[str] = ()
    sparse: Sequence[str] = ()
    parsed: Sequence[str] = ()
    only: str | None = None
    metrics: Mapping[str, Column] = field(default_factory=dict)
    counts: dict[str, Any] = field(default_factory=dict)

    def sorted(self) -> tuple[DataFrame, Observation]:
        seen = Observation()
        metrics = [F.count(F.lit(1)).alias("rows"), *(c.alias(k) for k, c in self.metrics.items())]
        return (self.table.orderBy(*self.order) if self.order else self.table).observe(seen, *metrics).drop(*self.drop), seen


    def collected(self) -> list[Any]:
        """The rows on the driver, as the document has them."""
        table, seen = self.sorted()
        found = [_element(r.value, self) for r in table.select(_as_json(table).alias("value")).collect()]
        self.counts = dict(seen.get)
        return found


def _as_json(table: DataFrame) -> Column:
    return F.to_json(F.struct(*(F.col(f"`{c}`") for c in table.columns)), {"ignoreNullFields": "false"})


def _element(value: str, rows: Rows) -> Any:
    out = json.loads(value)
    for name in rows.sparse:
        if out[name] is not None:
            out[name] = {k: v for k, v in out[name].items() if v is not None}
    for name in rows.parsed:
        if out[name] is not None:
            out[name] = json.loads(out[name])
    return out if rows.only is None else out[rows.only]


def pretty(value: Any, depth: int = 0, sort_keys: bool = True) -> str:
    """Sorted keys, two spaces a level; all but the first line are ``depth`` levels in."""
    return json.dumps(value, indent=2, sort_keys=sort_keys).replace("\n", "\n" + "  " * depth)


def _json_lines(rows: Rows, table: DataFrame, depth: int, sort_keys: bool) -> DataFrame:
    # What goes to the tasks must not hold the table itself.
    how = Rows(None, sparse=rows.sparse, parsed=rows.parsed, only=rows.only)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [f"{'  ' * depth}{pretty(_element(x, how), depth, sort_keys)}," for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.string())], names=["value"])

    return table.select(_as_json(table).alias("value")).mapInArrow(run, "value string")


def _csv_lines(table: DataFrame, header: Sequence[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [csv_line(x.values()) for x in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.string())], names=["value"])

    cell = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) if c in table.columns else F.lit("")
    return table.select(*(cell(c).alias(c) for c in header)).mapInArrow(run, "value string")


def csv_line(cells) -> str:
    out = io.StringIO()
    csv.writer(out, lineterminator="").writerow(["" if c is None else c for c in cells])
    return out.getvalue()


class _Writer:
    """A file that is written under another name and takes its place when all is well."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, hadoop = spark, spark._jvm.org.apache.hadoop
        self.copy, self.make, self.path = spark._jvm.org.apache.commons.io.IOUtils.copyLarge, hadoop.fs.Path, hadoop.fs.Path(path)
        # An own instance: others of this file system go on writing check sums.
        self.fs = hadoop.fs.FileSystem.newInstance(self.path.toUri(), spark._jsc.hadoopConfiguration())
        self.fs.setWriteChecksum(False)
        self.under = self.make(f"{path}.{uuid.uuid4().hex}.tmp")
        self.folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}.parts"
        self.tables, self.out = 0, None

    def __enter__(self) -> _Writer:
        return self

    def parts(self, lines: DataFrame, end: str = "\n") -> list[tuple[Any, int]]:
        """The lines written in order: the parts that have any, with their sizes."""
        self.tables += 1
        folder = f"{self.folder}/{self.tables}"
        lines.write.option("lineSep", end).option("compression", "none").text(folder)
        found = self.make(folder)
        listed = found.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(found)
        some = [(s.getPath().getName(), s.getPath(), s.getLen()) for s in listed if s.getLen()]
        return [(path, size) for name, path, size in sorted(some, key=lambda x: x[0]) if name.startswith("part-")]

    def text(self, value: str) -> None:
        if self.out is None:
            self.out = self.fs.create(self.under, True)
        self.out.write(bytearray(value.encode()))

    def copied(self, parts: Sequence[tuple[Any, int]], cut: int = 0) -> None:
        """The parts one behind the other, without the last ``cut`` bytes."""
        for k, (path, size) in enumerate(parts):
            given = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).open(path)
            self.copy(given, self.out, 0, size - (cut if k == len(parts) - 1 else 0))
            given.close()

    def __exit__(self, kind, *_) -> None:
        if self.out is not None:
            self.out.close()
        if kind is None:
            self.fs.delete(self.path, False)
            if not self.fs.rename(self.under, self.path):
                raise OSError(f"{self.under} could not be renamed")
        else:
            self.fs.delete(self.under, False)
        folder = self.make(self.folder)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        self.fs.close()


def json_document(spark: SparkSession, path: str, value: Any, *, sort_keys: bool = True) -> None:
    """A document of two spaces a level with a newline at the end. Wherever JSON may hold a list ``value`` may hold
    Rows, or a list of Rows, one behind the other; a function stands for what it gives once all rows are written,
    such as a count of them. Keys are sorted, or else in the order of dictionaries and columns."""
    with _Writer(spark, path) as out:
        made: dict[int, list[tuple[Any, int]]] = {}

        def write(v: Any, depth: int) -> None:
            if isinstance(v, Rows):
                table, seen = v.sorted()
                made[id(v)] = out.parts(_json_lines(v, table, depth + 1, sort_keys))
                v.counts = dict(seen.get)
            elif isinstance(v, dict):
                for x in v.values():
                    write(x, depth + 1)
            elif _tables(v):
                for x in v:
                    write(x, depth)

        def put(v: Any, depth: int) -> None:
            if callable(v):
                v = v()
            if isinstance(v, Rows) or _tables(v):
                parts = [p for x in (v if isinstance(v, list) else [v]) for p in made[id(x)]]
                out.text("[\n" if parts else "[]")
                out.copied(parts, cut=2)
                out.text("\n" + "  " * depth + "]" if parts else "")
            elif isinstance(v, dict) and v:
                for k, key in enumerate(sorted(v) if sort_keys else v):
                    out.text(("{" if not k else ",") + "\n" + "  " * (depth + 1) + json.dumps(key) + ": ")
                    put(v[key], depth + 1)
                out.text("\n" + "  " * depth + "}")
            else:
                out.text(pretty(v, depth, sort_keys))

        write(value, 0)
        put(value, 0)
        out.text("\n")


def _tables(value: Any) -> bool:
    return isinstance(value, list) and bool(value) and all(isinstance(x, Rows) for x in value)


def csv_document(spark: SparkSession, path: str, rows: Rows, header: Sequence[str]) -> None:
    """A CSV file under a fixed header; cells that a row lacks are empty."""
    with _Writer(spark, path) as out:
        table, seen = rows.sorted()
        parts = out.parts(_csv_lines(table, header), "\r\n")
        rows.counts = dict(seen.get)
        out.text(csv_line(header) + "\r\n")
        out.copied(parts)


def text_document(spark: SparkSession, path: str, rows: Rows, first: str) -> None:
    """A line of its own, then the one column of the rows, a value a line."""
    with _Writer(spark, path) as out:
        table, seen = rows.sorted()
        parts = out.parts(table.select(F.col(table.columns[0]).cast("string").alias("value")))
        rows.counts = dict(seen.get)
        out.text(first + "\n")
        out.copied(parts)
