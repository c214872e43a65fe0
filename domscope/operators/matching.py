"""Terms and suffixes as tables: which of many stand in a text, or end a host name."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of the terms of one automaton.
BLOCK_BYTES = 8 << 20

_automata: dict[str, ahocorasick.Automaton] = {}


def _automaton(name: str, terms: list[tuple[str, str]]) -> ahocorasick.Automaton:
    """One for each worker and block; of a key the numbers of its terms."""
    if name not in _automata:
        made = ahocorasick.Automaton()
        for k, (key, _) in enumerate(terms):
            made.add_word(key, [*made.get(key, ()), k])
        made.make_automaton()
        _automata[name] = made
    return _automata[name]


def finder(terms: DataFrame, *, block_bytes: int = BLOCK_BYTES) -> Callable[[Column], Column]:
    """A function of a text column that gives the ``value`` of each row of terms (key, value) whose key
    stands in the text, each once, by key and value.

    A text is run once through an automaton of all keys; terms beyond ``block_bytes`` make several, which
    go to the tasks one by one, so neither the driver nor a task holds more than one block to make it.
    Null and empty keys stand nowhere; a null text holds none; without terms no text holds any.
    """
    spark = terms.sparkSession
    terms = terms.select("key", "value").where("key <> '' AND value IS NOT NULL").distinct()
    size = terms.agg(F.coalesce(F.sum(F.octet_length("key") + F.octet_length("value")), F.lit(0))).first()[0]
    blocks = -(-int(size) // block_bytes)
    parts = []
    for b in range(blocks):
        own = terms.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b).orderBy("key", "value").collect()
        if own:
            parts.append(_block_finder(spark.sparkContext.broadcast([tuple(r) for r in own])))
    none = F.array().cast("array<string>")
    return lambda c: F.concat(none, *(p(c) for p in parts))


def _block_finder(held) -> Callable[[Column], Column]:
    name = uuid.uuid4().hex

    @F.pandas_udf("array<string>")
    def found(texts: pd.Series) -> pd.Series:
        terms = held.value
        automaton = _automaton(name, terms)
        out = []
        for text in texts:
            hits = sorted({k for _, ks in automaton.iter(text) for k in ks}) if text else []
            out.append([terms[k][1] for k in hits])
        return pd.Series(out, dtype=object)

    return lambda c: F.coalesce(found(c), F.array().cast("array<string>"))


def label_suffixes(host: Column) -> Column:
    """a.b.c, b.c and c of a host a.b.c; a null host has none."""
    labels = F.split(F.coalesce(host, F.lit("")), "[.]")
    return F.transform(
        labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels) - i), "."),
    )


def under_suffixes(rows: DataFrame, host: Column, suffixes: DataFrame, into: str) -> DataFrame:
    """rows with ``into``: whether the host is one of the suffixes (column ``suffix``) or ends with a dot and one.

    Each different host is looked up once for each of its labels, by an equi-join with the suffixes, however
    many these are. Null hosts are under none; repeated suffixes count once; a column ``into`` is replaced.
    """
    rows = rows.drop(into).withColumn("_host", host)
    asked = rows.select("_host").where("_host IS NOT NULL").distinct()
    labels = asked.select("_host", F.explode(label_suffixes(F.col("_host"))).alias("suffix"))
    known = suffixes.select("suffix").where("suffix <> ''").distinct()
    hit = labels.join(known, "suffix", "left_semi").select("_host").distinct().withColumn("_hit", F.lit(True))
    return rows.join(hit, "_host", "left").withColumn(into, F.coalesce("_hit", F.lit(False))).drop("_host", "_hit")
