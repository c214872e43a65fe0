"""Quality rules: a decision list learned from labelled statistics.

``statistics`` computes the statistics of each whole text in Arrow batches. ``learn`` grows and
prunes an ordered list of threshold conjunctions by sequential covering on a labelled table, and
``verdict`` turns the list into one ordered Spark conditional expression.

Defined results: a null or empty text has zero of everything and fails the base rule; repeated
rows give repeated results; an empty table gives an empty result; without labels (or with one
class only) the list is empty and the base rule alone decides. A label row with a null is unused;
of several labels of one document the smallest counts, of several documents with one id the one with the
least statistics teaches. Extra columns pass through ``apply``;
columns that clash with the statistics are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .vectext import SEPARATOR, Words, buffers, chunks, gram_hash, mix, prefix_hash, released, span_hash

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_upper", "n_digits", "n_bars", "n_marks", "n_lines")
#: Ratios on which rules set their thresholds, from the counts above.
FEATURES = ("words", "mean_word", "symbols", "dup_lines", "repeats", "upper", "digits", "bars", "marks")

#: Characters that count as symbols. Fixed values.
SYMBOLS = b"#*$%&|<>"


def _lut(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_COUNTED = {
    "n_symbols": _lut(SYMBOLS),
    "n_upper": _lut(bytes(range(0x41, 0x5B))),
    "n_digits": _lut(b"0123456789"),
    "n_bars": _lut(b"|"),
    "n_marks": _lut(b"!"),
}


def _sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def _repeated_before(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each (doc, key): whether it equals an earlier one, and whether any other one."""
    both = mix(key + mix(doc.astype(np.uint64)))
    order = np.argsort(both, kind="stable")
    same = both[order][1:] == both[order][:-1]
    later, twice = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:][same]] = True
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return later, twice


def text_statistics(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """Statistics of documents data[off[i]:off[i + 1]]."""
    n = len(off) - 1
    words = Words(data, off)
    out = {"n_words": words.counts.astype(np.int64)}
    lead = (data & 0xC0) != 0x80
    out["word_chars"] = _sums(lead & ~SEPARATOR[data], off)
    for name, lut in _COUNTED.items():
        at = np.flatnonzero(lut[data])
        out[name] = np.diff(np.searchsorted(at, off)).astype(np.int64)
    # Lines end at \n and at the end of a document.
    brk = np.flatnonzero(data == 0x0A)
    starts = np.unique(np.concatenate([off[:-1], brk + 1]))
    starts = starts[starts < len(data)]
    doc = np.searchsorted(off, starts, side="right") - 1
    ends = np.minimum(np.append(brk, len(data))[np.searchsorted(brk, starts)], off[doc + 1]) if len(starts) else starts
    full = np.searchsorted(words.start, ends) > np.searchsorted(words.start, starts)
    doc, starts, ends = doc[full], starts[full], ends[full]
    later, _ = _repeated_before(doc, span_hash(prefix_hash(data), starts, ends))
    out["n_dup_lines"] = np.bincount(doc[later], minlength=n).astype(np.int64)
    out["n_lines"] = np.bincount(doc, minlength=n).astype(np.int64)
    # 5-word windows that stand twice or more in a document cover their words.
    gram = gram_hash(words.hash, 5)
    wdoc = np.repeat(np.arange(n), words.counts)
    whole = wdoc[: len(gram)] == wdoc[4:] if len(gram) else np.zeros(0, bool)
    at = np.flatnonzero(whole)
    _, twice = _repeated_before(wdoc[at], gram[at])
    covered = np.zeros(len(words.start) + 1, bool)
    for k in range(5):
        covered[at[twice] + k] = True
    out["n_repeat_words"] = np.bincount(wdoc[covered[:-1]], minlength=n).astype(np.int64)
    return out


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the columns BASE and MORE, computed on whole texts."""
    names = [*BASE, *MORE]
    kept = docs.drop(*names)
    schema = T.StructType([*kept.schema.fields, *(T.StructField(x, T.LongType()) for x in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(batch.schema.get_field_index(text)))
            parts = [text_statistics(data[off[a] : off[b]], off[a : b + 1] - off[a]) for a, b in chunks(off)]
            more = [pa.array(np.concatenate([p[x] for p in parts]) if parts else np.zeros(0, np.int64)) for x in names]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *names])

    return kept.mapInArrow(released(run), schema)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def feature(name: str) -> Column:
    """The ratio as a Spark expression; the same arithmetic as ``_ratios``."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")
    return {
        "words": F.col("n_words").cast("double"),
        "mean_word": F.col("word_chars") / words,
        "symbols": F.col("n_symbols") / chars,
        "dup_lines": F.col("n_dup_lines") / lines,
        "repeats": F.col("n_repeat_words") / words,
        "upper": F.col("n_upper") / chars,
        "digits": F.col("n_digits") / chars,
        "bars": F.col("n_bars") / words,
        "marks": F.col("n_marks") / words,
    }[name]


@dataclass(frozen=True)
class Rule:
    """All conditions (feature, sign, threshold) hold: the document is rejected. sign: '>' or '<='."""

    conditions: tuple[tuple[str, str, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, sign, at in self.conditions:
            out = out & (feature(name) > at if sign == ">" else feature(name) <= at)
        return out

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), bool)
        for name, sign, at in self.conditions:
            out &= x[name] > at if sign == ">" else x[name] <= at
        return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, weight: np.ndarray, most: int, cuts: int) -> Rule:
    """Add the condition with the best information gain until no clean row is covered."""
    conditions: list[tuple[str, str, float]] = []
    live = np.ones(len(bad), bool)
    while len(conditions) < most and (live & ~bad).any():
        p0, n0 = weight[live & bad].sum(), weight[live & ~bad].sum()
        best, found = 1e-9, None
        for name in FEATURES:
            v = x[name][live]
            at = np.unique(np.quantile(v, np.linspace(0, 1, cuts)))
            at = np.unique(np.concatenate([at[:-1], (at[1:] + at[:-1]) / 2])) if len(at) > 1 else at[:0]
            if not len(at):
                continue
            order = np.argsort(v, kind="stable")
            where = np.searchsorted(v[order], at, side="right")
            p = np.concatenate([[0], np.cumsum((weight[live] * bad[live])[order])])[where]
            n = np.concatenate([[0], np.cumsum((weight[live] * ~bad[live])[order])])[where]
            for sign, pp, nn in (("<=", p, n), (">", p0 - p, n0 - n)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(
                        pp > 0,
                        pp * (np.log2(np.maximum(pp, 1e-9) / np.maximum(pp + nn, 1e-9)) - np.log2(p0 / (p0 + n0))),
                        0,
                    )
                k = int(np.argmax(gain))
                if gain[k] > best:
                    best, found = gain[k], (name, sign, float(at[k]))
        if found is None:
            break
        conditions.append(found)
        live &= x[found[0]] > found[2] if found[1] == ">" else x[found[0]] <= found[2]
    return Rule(tuple(conditions))


def _worth(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> float:
    got = rule.holds(x)
    p, n = (got & bad).sum(), (got & ~bad).sum()
    return (p - n) / (p + n) if p + n else -1.0


def sequential_covering(
    x: dict[str, np.ndarray],
    bad: np.ndarray,
    *,
    max_rules: int = 12,
    max_conditions: int = 3,
    cuts: int = 64,
    precision: float = 0.97,
    support: int = 5,
) -> list[Rule]:
    """Grow a rule on two thirds of the rows left, prune its last conditions on the other third, keep
    it while it is precise enough, remove what it covers, and go on."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    third = np.arange(len(bad)) % 3 == 2
    while len(rules) < max_rules and (left & bad).sum() >= support:
        take = lambda m: ({k: v[m] for k, v in x.items()}, bad[m])
        (gx, gb), (px, pb) = take(left & ~third), take(left & third)
        if not gb.any() or not (~gb).any():
            break
        rule = _grow(gx, gb, np.ones(len(gb)), max_conditions, cuts)
        shorter = [Rule(rule.conditions[:k]) for k in range(1, len(rule.conditions) + 1)]
        if not shorter:
            break
        rule = max(shorter, key=lambda r: (_worth(r, px, pb), len(r.conditions)))
        got = rule.holds(x) & left
        p, n = (got & bad).sum(), (got & ~bad).sum()
        if p < support or p < precision * (p + n):
            break
        rules.append(rule)
        left &= ~got
    return rules


def _ratios(rows: np.ndarray, names: list[str]) -> dict[str, np.ndarray]:
    c = {k: rows[:, i].astype(float) for i, k in enumerate(names)}
    words, chars, lines = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1), np.maximum(c["n_lines"], 1)
    return {
        "words": c["n_words"],
        "mean_word": c["word_chars"] / words,
        "symbols": c["n_symbols"] / chars,
        "dup_lines": c["n_dup_lines"] / lines,
        "repeats": c["n_repeat_words"] / words,
        "upper": c["n_upper"] / chars,
        "digits": c["n_digits"] / chars,
        "bars": c["n_bars"] / words,
        "marks": c["n_marks"] / words,
    }


def learn(docs: DataFrame, labels: DataFrame, *, sample: int = 8000, **options) -> list[Rule]:
    """Fit the decision list on at most ``sample`` labelled documents (those of least id hash).

    labels: doc_id and quality (0 or 1). Only the statistics of the sample reach the driver.
    """
    one = labels.where(
        F.col("quality").isNotNull() & F.col("doc_id").isNotNull()
    ).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    least = one.select("doc_id", "quality", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(sample)
    names = [*BASE, *MORE]
    found = statistics(docs.select("doc_id", "text").join(F.broadcast(least.select("doc_id", "quality")), "doc_id"))
    # One row for each label, however many documents share its id.
    rows = found.groupBy("doc_id", "quality").agg(
        F.min(F.struct(*names)).alias("s")
    ).select("doc_id", "quality", "s.*").collect()
    if not rows:
        return []
    rows.sort(key=lambda r: (hash_order(r[0]), *r[1:]))
    table = np.array([[r[k] for k in names] for r in rows], dtype=np.int64)
    bad = np.array([r["quality"] == 0 for r in rows])
    passed = ~((table[:, 0] < 10) | (100 * table[:, 4] > 20 * table[:, 0]))
    x = {k: v[passed] for k, v in _ratios(table, names).items()}
    return sequential_covering(x, bad[passed], **options) if passed.any() else []


def hash_order(doc_id: int) -> int:
    return (int(doc_id) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF


def verdict(rules: list[Rule]) -> Column:
    """kept: the base rule first, then the learned rules in order, otherwise kept."""
    out = F.when(base_failed(), F.lit(False))
    for rule in rules:
        out = out.when(rule.column(), F.lit(False))
    return out.otherwise(F.lit(True))


def fired(rules: list[Rule]) -> Column:
    """Which rule decided: 0 the base, 1.. the learned ones, null none."""
    out = F.when(base_failed(), F.lit(0))
    for k, rule in enumerate(rules):
        out = out.when(rule.column(), F.lit(k + 1))
    return out


def apply(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """docs with the statistics, base_failed, rule and kept."""
    return statistics(docs).drop("base_failed", "rule", "kept").withColumns(
        {"base_failed": base_failed(), "rule": fired(rules), "kept": verdict(rules)}
    )
