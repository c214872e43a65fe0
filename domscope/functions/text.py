"""Strings and lists as Column builders.

``strip`` follows Python's notion of white space; Spark's ``trim`` takes spaces only.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def strings(*values: str) -> Column:
    return F.array(*(F.lit(v) for v in values)) if values else F.array().cast("array<string>")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def title(c: Column) -> Column:
    """Letters behind a letter in lower case, others in upper case, as Python's title() has it."""
    signs = F.split(c, "")
    after = lambda i: F.coalesce(F.get(signs, i - 1).rlike(r"\p{L}"), F.lit(False))
    return F.array_join(F.transform(signs, lambda x, i: F.when(after(i), F.lower(x)).otherwise(F.upper(x))), "")


def blank(c: Column) -> Column:
    """Null or white space only."""
    return F.coalesce(strip(c) == "", F.lit(True))


def text(c: Column) -> Column:
    """A null cell as an empty string, else stripped."""
    return F.coalesce(strip(c), F.lit(""))


def split_on(c: Column, pattern: str) -> Column:
    """Stripped, non-empty parts; null gives an empty list."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), pattern), strip), lambda x: x != "")


def split_pipe(c: Column) -> Column:
    return split_on(c, "[|]")


def split_tokens(c: Column) -> Column:
    return split_on(c, r"(?U)[|\s,]+")


def parse_float(c: Column, default: float = 0.0) -> Column:
    """A number as Python's float() reads plain decimals, else default. Suffixes like 1.5d are not numbers."""
    s = strip(c)
    plain = s.rlike(r"(?i)^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)?$")
    return F.coalesce(F.when(plain, s.try_cast("double")), F.lit(default))


def confidence(*cells: Column) -> Column:
    """The first alias that says something: words, or a number; low ends the search with null."""

    def said(c: Column) -> Column:
        s = F.lower(text(c))
        number = parse_float(s, float("nan"))
        value = F.when(s.isin("high", "hi"), 0.92).when(s.isin("medium", "med", "mid"), 0.8).when(
            (s != "low") & ~F.isnan(number),
            number,
        )
        return F.struct(value.alias("v"), (s == "low").alias("low"))

    every = F.filter(F.array(*(said(c) for c in cells)), lambda x: x["v"].isNotNull() | x["low"])
    return F.get(every, F.lit(0))["v"] if cells else F.lit(None).cast("double")


def norm_key(c: Column) -> Column:
    """Lower case, white space collapsed, stripped; null stays null and blank gives an empty string."""
    return strip(F.regexp_replace(F.lower(c), r"(?U)\s+", " "))


def norm_blob(*parts: Column) -> Column:
    """Lower-cased non-blank parts joined by a space."""
    return strip(F.lower(F.array_join(F.filter(F.array(*parts), lambda p: ~blank(p)), " ")))


def first_nonempty(*cells: Column) -> Column:
    return F.coalesce(*(F.nullif(text(c), F.lit("")) for c in cells), F.lit(""))


def legal_keys(c: Column) -> Column:
    """Distinct keys of a legal-name cell split on | ; and ,."""
    return F.array_distinct(
        F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "[|;,]+"), norm_key), lambda k: k != "")
    )


def slug_domain(c: Column) -> Column:
    head = F.replace(F.split_part(F.lower(text(c)), F.lit("/"), F.lit(1)), F.lit("."), F.lit("_"))
    s = F.regexp_replace(F.regexp_replace(head, "[^a-z0-9_]+", "_"), "^_+|_+$", "")
    return F.when(s == "", "unknown").otherwise(s)


def operator_id(domain: Column) -> Column:
    return F.concat(F.lit("operator_"), slug_domain(domain))


def dedupe_sorted(values: Column, lower: bool) -> Column:
    """Keep the first of each spelling up to case, then sort by lower case; ties keep their order."""
    clean = F.filter(F.transform(F.coalesce(values, strings()), strip), lambda x: x.isNotNull() & (x != ""))
    if lower:
        return F.array_sort(F.array_distinct(F.transform(clean, F.lower)))
    keys = F.transform(clean, F.lower)
    kept = F.filter(
        F.transform(clean, lambda x, i: F.struct(F.lower(x).alias("k"), i.alias("i"), x.alias("x"))),
        lambda s: F.array_position(keys, s["k"]) == s["i"] + 1,
    )
    return F.transform(F.array_sort(kept), lambda s: s["x"])


def merge_lists(a: Column, b: Column, lower: bool) -> Column:
    return dedupe_sorted(F.concat(F.coalesce(a, strings()), F.coalesce(b, strings())), lower)


def cluster_key(legal: Column, parent: Column) -> Column:
    le, pc = F.lower(text(legal)), F.lower(text(parent))
    return F.when(pc != "", F.concat(F.lit("parent:"), pc)).when(le != "", F.concat(F.lit("legal:"), le))


def contains_any(c: Column, needles: Sequence[str]) -> Column:
    """Whether one of the needles, which are literals, stands in c. A null c holds none."""
    pattern = "|".join(re.escape(n) for n in needles) or "(?!)"
    return F.coalesce(F.rlike(c, F.lit(pattern)), F.lit(False))


def term_hits(blob: Column, terms: Sequence[str]) -> Column:
    """How many of the terms stand in blob as substrings; each counts once."""
    out = F.lit(0)
    for t in terms:
        out = out + F.contains(blob, F.lit(t)).cast("int")
    return F.coalesce(out, F.lit(0))
