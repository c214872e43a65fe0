"""Records of large text files, read by splits: quoted CSV records and elements of JSON arrays.

A record may hold what separates records, so where one begins depends on all text before it. Spark reads
a file in splits, cut at every separator (a line end, or a comma in JSON). A first reading sums up each
split for every state it can begin in: the state it ends in, and how many records begin in it. These
sums, one row for each split, are followed from the first split of a file to the last on the driver. Then
each split is read again from its true state and gives its whole records; of a record that goes beyond its
split each split gives its piece, and the pieces are joined. Records are numbered by file, files by path.

Defined results: an empty file has no records; broken UTF-8 is replaced; a last record without its end is
a record; a split that is cut otherwise in the second reading is an error, not a loss.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What a split begins in.
State = tuple[int, int, int]


class Csv:
    """Records of lines. A state says whether a quoted cell is open. Blank lines are no records."""

    separator = "\n"
    headers = 1
    first: State = (0, 0, 0)

    @staticmethod
    def _after(line: str, open_: int) -> int:
        """Whether a quoted cell is open behind the line; a quote matters at the start of a cell alone."""
        at, n = 0, len(line)
        while True:
            if not open_:
                if at < n and line[at] == '"':
                    at, open_ = at + 1, 1
                else:
                    at = line.find(",", at) + 1
                    if not at:
                        return 0
                    continue
            while True:
                at = line.find('"', at) + 1
                if not at:
                    return 1
                if line[at : at + 1] != '"':
                    break
                at += 1
            open_ = 0
            at = line.find(",", at) + 1
            if not at:
                return 0

    def summary(self, lines: Iterator[str]) -> list[list[int]]:
        """For an open cell at the start or not: (open at the end, records begun)."""
        state, begun = [0, 1], [0, 0]
        for line in lines:
            some = bool(line.rstrip("\r"))
            quoted = '"' in line
            for k in (0, 1):
                begun[k] += some and not state[k]
                if quoted:
                    state[k] = self._after(line, state[k])
        return [[state[k], begun[k]] for k in (0, 1)]

    def follow(self, state: State, summary: Any) -> tuple[State, int]:
        open_, begun = summary[state[0]]
        return (open_, 0, 0), begun

    def records(self, lines: Iterator[str], state: State) -> Iterator[tuple[int, str, bool]]:
        """(records begun before it here, text, whether it is whole)."""
        open_, k, whole = state[0], -1 if state[0] else 0, not state[0]
        held: list[str] = []
        for line in lines:
            if not open_ and not line.rstrip("\r"):
                continue
            held.append(line)
            open_ = self._after(line, open_) if '"' in line else open_
            if not open_:
                yield k, "\n".join(held), whole
                held, whole, k = [], True, k + 1
        if held:
            yield k, "\n".join(held), False


_STRUCTURE = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\\?$)|[\[\]{}]', re.S)
_REST_OF_STRING = re.compile(r'(?:[^"\\]|\\.)*"', re.S)


@dataclass
class Json:
    """Elements of the array ``field`` of the object that a file holds, or (None) of the array it holds.

    Text is cut at commas. A state says whether a string is open, how deep brackets are, and whether the
    container that was opened last under the element's array is this array."""

    field: str | None = None
    separator = ","
    headers = 0

    def __post_init__(self):
        self.depth = 1 if self.field is None else 2
        self.first: State = (0, 0, 0)
        self._key = re.compile(r'"((?:[^"\\]|\\.)*)"\s*:\s*$', re.S)

    def _ours(self, before: str) -> bool:
        """Whether a container that is opened behind this text is the array."""
        if self.field is None:
            return not before.strip().lstrip("﻿")
        key = self._key.search(before)
        return bool(key) and json.loads(f'"{key.group(1)}"', strict=False) == self.field

    @staticmethod
    def _marks(piece: str, open_: int) -> tuple[list[tuple[int, str]], int]:
        """Brackets outside strings, and whether a string is open at the end."""
        at = 0
        if open_:
            end = _REST_OF_STRING.match(piece)
            if not end:
                return [], 1
            at = end.end()
        marks = []
        for m in _STRUCTURE.finditer(piece, at):
            text = m.group()
            if text[0] != '"':
                marks.append((m.start(), text))
            elif len(text) < 2 or not _REST_OF_STRING.fullmatch(text, 1):
                return marks, 1
        return marks, 0

    def summary(self, pieces: Iterator[str]) -> list[Any]:
        """For an open string at the start or not: the string state and the change of depth at the end; by
        relative depth, whether the last container opened there is ours, and the elements counted inside it
        before any was opened and inside ours."""
        runs = [[k, 0, {}, {}, {}] for k in (0, 1)]
        for piece in pieces:
            plain = not ('"' in piece or "[" in piece or "{" in piece or "]" in piece or "}" in piece)
            for run in runs:
                marks, run[0] = ([], run[0]) if plain else self._marks(piece, run[0])
                _, depth, last, early, ours = run
                for at, mark in marks:
                    if mark in "[{":
                        last[depth] = mine = int(mark == "[" and self._ours(piece[:at]))
                        if mine and piece[at + 1 :].lstrip()[:1] != "]":
                            ours[depth + 1] = ours.get(depth + 1, 0) + 1
                        depth += 1
                    else:
                        depth -= 1
                run[1] = depth
                if not run[0]:  # the comma behind this piece
                    if depth - 1 not in last:
                        early[depth] = early.get(depth, 0) + 1
                    elif last[depth - 1]:
                        ours[depth] = ours.get(depth, 0) + 1
        return runs

    def follow(self, state: State, summary: Any) -> tuple[State, int]:
        open_, depth, mine = state
        open_, change, last, early, ours = summary[open_]
        at = lambda d, k: d.get(str(k), 0)
        own = self.depth - depth  # the array's relative depth
        begun = at(ours, own) + (at(early, own) if mine else 0)
        return (open_, depth + change, last.get(str(own - 1), mine)), begun

    def records(self, pieces: Iterator[str], state: State) -> Iterator[tuple[int, str, bool]]:
        """(elements begun before it here, text, whether it is whole). At the start of a split an element begins
        if the comma before it stood in the array itself."""
        open_, depth, mine = state
        inside = mine and depth >= self.depth
        fresh = inside and depth == self.depth and not open_
        # The element that begins here was counted with the comma before it.
        k, whole = -1, fresh
        held: list[str] = []
        for piece in pieces:
            marks, open_ = self._marks(piece, open_)
            start = 0
            for at, mark in marks:
                if mark in "[{":
                    if depth == self.depth - 1:
                        mine = int(mark == "[" and self._ours(piece[:at]))
                        inside, start = bool(mine), at + 1
                        whole = True
                        if inside and piece[at + 1 :].lstrip()[:1] != "]":
                            k += 1
                    depth += 1
                else:
                    depth -= 1
                    if inside and depth == self.depth - 1:
                        held.append(piece[start:at])
                        if any(x.strip() for x in held):
                            yield k, ",".join(held), whole
                        held, inside = [], False
            if inside:
                held.append(piece[start:])
                if depth == self.depth and not open_:
                    yield k, ",".join(held), whole
                    held, whole, k = [], True, k + 1
        if inside and held:
            yield k, ",".join(held), False


def _pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    return spark.read.option("lineSep", separator).text(path).select(
        F.make_valid_utf8("value").alias("value"),
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"),
        F.col("_metadata.file_path").alias("path"),
    )


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[str]]]:
    """(first values of the columns behind value, the pieces) of each split."""

    def rows() -> Iterator[tuple[tuple, list[str]]]:
        for batch in batches:
            marks = np.stack([batch.column(k).to_numpy() for k in (1, 2)])
            cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a < b:
                    rest = tuple(batch.column(k)[a].as_py() for k in range(1, batch.num_columns))
                    yield rest, batch.column(0).slice(a, b - a).to_pylist()

    for key, group in groupby(rows(), key=lambda x: x[0][:2]):
        first, pieces = next(group)

        def all_(pieces=pieces, group=group) -> Iterator[str]:
            yield from pieces
            for _, more in group:
                yield from more

        yield first, all_()


def one_split(spark: SparkSession, path: str) -> bool:
    """Whether the path is one file that Spark reads in one split, whatever the number of cores."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p)
    most = spark._jsparkSession.sessionState().conf()
    return found.getFileCount() == 1 and found.getLength() <= min(most.filesMaxPartitionBytes(), most.filesOpenCostInBytes())


def split_states(spark: SparkSession, path: str, grammar: Csv | Json) -> tuple[DataFrame, list[str]]:
    """(file, start, length, s0, s1, s2, before, base) of each split, and the files.

    A row of numbers for each split, so some megabytes for a file of a hundred terabytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, start, length, path), pieces in _by_split(batches):
            row = {"file": file, "start": start, "length": length, "path": path, "summary": json.dumps(grammar.summary(pieces))}
            yield pa.RecordBatch.from_pylist([row])

    found = _pieces(spark, path, grammar.separator).mapInArrow(
        run, "file long, start long, length long, path string, summary string",
    )
    splits = sorted(found.collect(), key=lambda r: (r.path, r.start))
    out, base, paths = [], 0, []
    for name, group in groupby(splits, key=lambda r: r.path):
        state, before = grammar.first, 0
        paths.append(name)
        for r in group:
            out.append((r.file, r.start, r.length, *state, before, base))
            state, begun = grammar.follow(state, json.loads(r.summary))
            before += begun
        base += max(before - grammar.headers, 0)
    schema = "file long, start long, length long, s0 int, s1 int, s2 int, before long, base long"
    return spark.createDataFrame(out, schema), paths


def records(spark: SparkSession, path: str, grammar: Csv | Json) -> DataFrame:
    """(place, base, value): each record's text, its place in its file from 0 on, and the records of the files
    before (of CSV files without their headers)."""
    read = _pieces(spark, path, grammar.separator).drop("path")
    if one_split(spark, path):
        known = dict(zip(("s0", "s1", "s2", "before", "base"), (*grammar.first, 0, 0), strict=True))
        read = read.withColumns({k: F.lit(v) for k, v in known.items()})
    else:
        read = read.join(F.broadcast(split_states(spark, path, grammar)[0]), ["file", "start", "length"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, start, s0, s1, s2, before, base), pieces in _by_split(batches):
            if before is None:
                raise RuntimeError(f"{path} was cut otherwise when it was read first")
            rows: list[dict] = []
            for k, text, whole in grammar.records(pieces, (s0, s1, s2)):
                rows.append({"place": before + k, "base": base, "value": text, "whole": whole, "file": file, "start": start})
                if len(rows) == 1024:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema(
        [("place", pa.int64()), ("base", pa.int64()), ("value", pa.string()), ("whole", pa.bool_()), ("file", pa.int64()), ("start", pa.int64())]
    )
    made = read.select("value", "file", "start", "s0", "s1", "s2", "before", "base").mapInArrow(
        run, "place long, base long, value string, whole boolean, file long, start long",
    )
    parts = made.where("NOT whole").groupBy("file", "place", "base").agg(
        F.array_sort(F.collect_list(F.struct("start", "value"))).alias("parts")
    )
    joined = F.array_join(F.transform("parts", lambda p: p["value"]), grammar.separator)
    return made.where("whole").select("place", "base", "value").unionByName(parts.select("place", "base", joined.alias("value")))
