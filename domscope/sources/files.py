"""File sources and sinks of tables (``documents`` has single files). Schemas are explicit; a missing path gives an empty table."""

from __future__ import annotations

import csv
import json
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip
from . import splits

#: Lines that a CSV header may take.
HEADER_LINES = 1000


def exists(spark: SparkSession, path: str) -> bool:
    """Through Hadoop's file systems, so that any store Spark reads will do."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def csv_table(spark: SparkSession, path: str, columns: Sequence[str], *, trimmed: bool = False) -> DataFrame:
    """All cells as strings, blanks for missing ones, and ``ordinal``, the row's place from 1 on; rows of
    several files are numbered by path.

    The header, a file's first record, names the columns, of equal names the last one; those of ``columns``
    that it lacks are empty. All files must have one header. Cells are quoted as Python's csv has it.
    """
    schema = T.StructType(
        [*(T.StructField(c, T.StringType()) for c in columns), T.StructField("ordinal", T.LongType())]
    )
    header = _header(spark, path) if exists(spark, path) else None
    if header is None:
        return spark.createDataFrame([], schema)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(sys.maxsize)
        for batch in batches:
            found = pa.array([_cells(x) for x in batch.column(1).to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["ordinal", "cells"])

    first = F.ltrim(F.rtrim("value", F.lit("\r")), F.lit("\ufeff"))
    same = F.when(first != header, F.raise_error(F.lit(f"files of {path} have different headers")).cast("boolean"))
    found = splits.records(spark, path, splits.Csv()).where(
        F.when(F.col("place") == 0, F.coalesce(same, F.lit(False))).otherwise(F.lit(True))
    )
    rows = found.select((F.col("base") + F.col("place")).alias("ordinal"), "value").mapInArrow(
        cells, "ordinal long, cells array<string>",
    )
    have = {c.strip(): k for k, c in enumerate(_cells(header))}
    cell = lambda c: F.coalesce(F.get("cells", F.lit(have[c])), F.lit("")) if c in have else F.lit("")
    return rows.select(
        *(
            (strip(cell(c)) if trimmed else cell(c)).alias(c)
            for c in dict.fromkeys([*columns, *(h for h in have if h not in columns)])
        ),
        "ordinal",
    )


def _cells(record: str) -> list[str]:
    """A bare carriage return outside quotes is a blank."""
    *lines_, last = record.rstrip("\r").split("\n")
    rows = [*(x + "\n" for x in lines_), last]
    try:
        return next(csv.reader(rows), [])
    except csv.Error:
        return next(csv.reader([x.replace("\r", " ") for x in rows]), [])


def _header(spark: SparkSession, path: str) -> str | None:
    """The first record of the first file."""
    csv.field_size_limit(sys.maxsize)
    lines_ = spark.read.option("lineSep", "\n").text(path).select(
        F.make_valid_utf8("value").alias("value"), F.col("_metadata.file_path").alias("path"),
    ).where("_metadata.file_block_start = 0")
    if not splits.one_split(spark, path):
        lines_ = lines_.where(F.col("path") == lines_.agg(F.min("path")).first()[0])
    found = [r.value for r in lines_.limit(HEADER_LINES).collect()]
    if found:
        found[0] = found[0].lstrip("\ufeff")
    return next((text.rstrip("\r") for _, text, _ in splits.Csv().records(iter(found), splits.Csv.first)), None)


def json_elements(spark: SparkSession, path: str, field: str | None = None) -> DataFrame:
    """(value, ordinal): text of the elements of a JSON array, or of the array ``field`` of one JSON object;
    ordinals from 0 on, those of several files by path."""
    if not exists(spark, path):
        return spark.createDataFrame([], "value string, ordinal long")
    return splits.records(spark, path, splits.Json(field)).select(
        "value", (F.col("base") + F.col("place")).alias("ordinal"),
    )


def json_rows(spark: SparkSession, path: str, schema: T.StructType, field: str | None = None) -> DataFrame:
    """``json_elements`` as rows, with ``ordinal``; an element that is no object is a row of nulls."""
    rows = json_elements(spark, path, field).select(F.from_json("value", schema).alias("r"), "ordinal")
    return rows.select(*(F.col(f"r.{f.name}").alias(f.name) for f in schema.fields), "ordinal")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, ordinal) of a text file."""
    if not exists(spark, path):
        return spark.createDataFrame([], "value string, ordinal long")
    return spark.read.text(path).withColumn("ordinal", F.monotonically_increasing_id())


def domain_records(documents: DataFrame, value: str = "value") -> DataFrame:
    """Domain fingerprints (schemas.DOMAIN_FINGERPRINT) of JSON objects {domain: record}.

    Each field is taken under the first of its names that is not empty; a scalar stands for a list of
    one; records that are no objects are left out; of equal domains the last one counts.
    """
    from ..functions.hosts import plain_domain
    from ..operators.keyed import keep_last

    doc = documents.select(F.try_parse_json(value).alias("d"))
    entry = doc.lateralJoin(documents.sparkSession.tvf.variant_explode(F.col("d").outer()))
    rows = entry.where("key IS NOT NULL").withColumn("domain", plain_domain(F.col("key"))).where(
        (F.col("domain") != "") & F.startswith(F.schema_of_variant("value"), F.lit("OBJECT"))
    )

    def strings(path: str):
        v = F.try_variant_get("value", path, "variant")
        many = F.try_variant_get("value", path, "array<string>")
        one = F.when(F.schema_of_variant(v) == "STRING", F.array(F.try_variant_get("value", path, "string")))
        clean = F.filter(F.transform(F.coalesce(one, many), strip), lambda x: x.isNotNull() & (x != ""))
        return F.when(F.size(clean) > 0, clean)

    def flag(path: str):
        return F.coalesce(F.try_variant_get("value", path, "boolean"), F.lit(False))

    empty = F.array().cast("array<string>")
    mail = lambda path: (lambda m: F.when(F.size(m) > 0, m))(
        F.filter(F.try_variant_get("value", path, "array<struct<host:string,priority:int>>"), lambda x: x.isNotNull())
    )
    sans = F.transform(F.coalesce(strings("$.sans"), strings("$.san"), strings("$.tls.sans"), empty), plain_domain)
    found = rows.select(
        "domain",
        "pos" if "pos" in rows.columns else F.lit(0).alias("pos"),
        sans.alias("sans"),
        F.coalesce(strings("$.nameservers"), strings("$.dns.nameservers"), empty).alias("nameservers"),
        F.coalesce(
            mail("$.mx"),
            mail("$.dns.mx"),
            F.array().cast("array<struct<host:string,priority:int>>"),
        ).alias("mx"),
        (flag("$.partial") | flag("$.tls.partial")).alias("tls_partial"),
        (flag("$.partial") | flag("$.dns.partial")).alias("dns_partial"),
    )
    return keep_last(found, ["domain"], ["pos"]).drop("pos")


def _given(rows: DataFrame, *names: str):
    """The first of the columns with a value that says something; null if there is none."""
    cells = [F.nullif(strip(F.col(n).cast("string")), F.lit("")) for n in names if n in rows.columns]
    return F.coalesce(*cells) if cells else F.lit(None).cast("string")


def dump_rows(rows: DataFrame) -> DataFrame:
    """Rows of an affiliation dump under fixed names: from_domain (or left), to_domain (or right),
    relationship (related_to), confidence (0.5), notes and sources. rows carry ``ordinal``."""
    return rows.select(
        "ordinal",
        F.coalesce(_given(rows, "from_domain", "left"), F.lit("")).alias("from_domain"),
        F.coalesce(_given(rows, "to_domain", "right"), F.lit("")).alias("to_domain"),
        F.coalesce(_given(rows, "relationship"), F.lit("related_to")).alias("relationship"),
        F.coalesce(_given(rows, "confidence").try_cast("double"), F.lit(0.5)).alias("confidence"),
        F.coalesce(_given(rows, "notes"), F.lit("")).alias("notes"),
        F.coalesce(_given(rows, "sources"), F.lit("")).alias("sources"),
    )


def whole_text(spark: SparkSession, path: str) -> str | None:
    """A small file on the driver, from any store that Spark reads; null if it is not there."""
    found = [r.value for r in spark.read.text(path, wholetext=True).collect()] if exists(spark, path) else [None]
    return "".join(found) if found != [None] else None


def json_lines(df: DataFrame, path: str) -> None:
    """Large tables: JSON lines with nulls and columns in name order."""
    df.select(*sorted(df.columns)).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def csv_file(df: DataFrame, path: str, header: Sequence[str]) -> None:
    df.select(*header).write.mode("overwrite").csv(path, header=True, escape='"')
