"""Byte-level BPE encoding and decoding by a pair occurrence index.

The distinct words of a block of texts lie in one symbol array with links to the left and right
neighbour. An index maps each mergeable pair to all its positions; the active ranks are applied in
ascending order, each to all positions at once, and the pairs that a merge creates join the index.
Words that were met before come from a table of bounded size, so a word is merged once per block
at most.

Defined results: a null text counts as empty and has no ids; an empty table gives an empty
result; repeated rows give repeated results; other columns pass through, ``ids`` and ``decoded``
are replaced. Memory follows one block of texts (``BLOCK_CHARS``, or one longer text).
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .vectext import buffers, mix, powers, released

BLOCK_CHARS = 2_000_000
SPLIT_CHARS = 250_000
TABLE_WORDS = 100_000

#: Classes of code points for the word pattern
#: 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
OTHER, LETTER, NUMBER, SPACE, END = range(5)
_STOP = 0x110000  # stands between texts; special token k is _STOP + 1 + k
_APOSTROPHE, _BLANK = 0x27, 0x20
#: Letters that an apostrophe takes along. Fixed values.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@cache
def classes() -> np.ndarray:
    """The class of each code point; white space is Unicode White_Space."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.zeros(_STOP + 256, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            out[ord(m.group()[0]) : ord(m.group()[-1]) + 1] = kind
    out[_STOP:] = END
    return out


def token_bounds(cp: np.ndarray) -> np.ndarray:
    """Starts of the tokens of a code point array in which _STOP and special codes stand alone."""
    kind = classes()[cp]
    n = len(cp)
    first = np.ones(n + 1, bool)
    first[1:n] = (kind[1:] != kind[:-1]) | (kind[1:] == END)
    start = np.flatnonzero(first)
    run, ends = start[:-1], start[1:]
    spaces = (kind[run] == SPACE) & (ends < n)
    spaces[spaces] = kind[ends[spaces]] != END
    last = ends[spaces] - 1
    first[last] = True
    joins = last[cp[last] == _BLANK] + 1
    first[joins] = False
    quote = (
        np.flatnonzero((cp[:-1] == _APOSTROPHE) & first[:n][:-1] & first[1:n] & (kind[1:] == LETTER))
        if n > 1
        else np.zeros(0, np.int64)
    )
    for q in quote.tolist():
        for c in CONTRACTIONS:
            if q + 1 + len(c) <= n and cp[q + 1 : q + 1 + len(c)].tolist() == list(map(ord, c)):
                first[q + 1] = False
                first[q + 1 + len(c)] = True
                break
    return np.flatnonzero(first[:n])


class _Slots(dict):
    """Numbers new words in order of arrival."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def byte_letters() -> list[str]:
    """The printable letter by which a vocabulary file writes each byte."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0x100
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


def refused(spec: dict) -> list[str]:
    """What a vocabulary file asks for that this encoder does not do."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    out = [] if model.get("type", "BPE") == "BPE" else [f"model {model['type']}"]
    out += [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(k)]
    out += ["normalizer"] if spec.get("normalizer") else []
    if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        out.append("pre_tokenizer")
    return (
        out
        + [
            f"{k} of {t['content']!r}"
            for t in spec.get("added_tokens", [])
            for k in ("lstrip", "rstrip", "single_word", "normalized")
            if t.get(k) and (k != "normalized" or spec.get("normalizer"))
        ]
    )


class PairIndexBPE:
    """Encoder and decoder for one vocabulary file (the JSON text); files that ask for more are refused."""

    def __init__(self, file: str):
        spec = json.loads(file)
        if bad := refused(spec):
            raise ValueError(f"the vocabulary asks for what is not supported: {', '.join(bad)}")
        vocab: dict[str, int] = spec["model"]["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        letters = byte_letters()
        back = {c: b for b, c in enumerate(letters)}
        self.byte_id = np.array([vocab[c] for c in letters], dtype=np.int64)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.token: list[bytes] = [b""] * self.size
        for t, i in vocab.items():
            self.token[i] = bytes(back[c] for c in t)
        for t, i in self.special.items():
            self.token[i] = t.encode()
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        self.pair_of_rank, self.made_of_rank = keys, made
        self.order = np.argsort(keys, kind="stable")
        self.sorted_keys = keys[self.order]
        self.split = (
            regex.compile("(" + "|".join(regex.escape(x) for x in sorted(self.special, key=len, reverse=True)) + ")")
            if self.special
            else None
        )
        self._clear()

    def _clear(self) -> None:
        self.slot = _Slots()
        for t in self.special:
            self.slot[f"\0{t}"]
        self.first = np.arange(len(self.special))
        self.length = np.ones(len(self.special), np.int64)
        self.value = np.array(list(self.special.values()), np.int32)

    def _learn(self) -> None:
        """Merge the words that have no ids yet."""
        new = list(islice(self.slot, len(self.length), None))
        if new:
            value, lengths = self.merge([w.encode() for w in new])
            self.first = np.concatenate([self.first, len(self.value) + np.cumsum(lengths) - lengths])
            self.length = np.concatenate([self.length, lengths])
            self.value = np.concatenate([self.value, value])

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where there is none."""
        key = left * self.size + right
        at = np.searchsorted(self.sorted_keys, key)
        at[at == len(self.sorted_keys)] = 0
        return np.where(self.sorted_keys[at] == key, self.order[at], -1)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, number of ids of each word)."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbol = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        n = len(symbol)
        after = np.arange(1, n + 1)
        after[np.cumsum(lengths) - 1] = n
        before = np.arange(-1, n - 1)
        before[np.cumsum(lengths) - lengths] = n
        after, before = np.append(after, n), np.append(before, n)
        symbol = np.append(symbol, -1)
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def note(at: np.ndarray) -> None:
            rank = self.ranks(symbol[at], symbol[after[at]])
            real = rank >= 0
            at, rank = at[real], rank[real]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cut = np.flatnonzero(np.diff(rank)) + 1
            for r, part in zip(rank[np.concatenate([[0], cut])].tolist(), np.split(at, cut), strict=True):
                if r in index:
                    index[r].append(part)
                else:
                    index[r] = [part]
                    heapq.heappush(heap, r)

        note(np.flatnonzero(after[:n] < n))
        while heap:
            r = heapq.heappop(heap)
            parts = index.pop(r)
            a, b = divmod(int(self.pair_of_rank[r]), self.size)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            at = at[(symbol[at] == a) & (symbol[after[at]] == b)]
            if a == b and len(at) > 1:  # of overlapping places the first, third, ... of a run
                follows = np.concatenate([[False], before[at[1:]] == at[:-1]])
                k = np.arange(len(at))
                head = np.maximum.accumulate(np.where(follows, 0, k))
                at = at[(k - head) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            beyond = after[gone]
            symbol[at] = self.made_of_rank[r]
            symbol[gone] = -1
            after[at] = beyond
            before[beyond] = at
            before[n] = n
            left = before[at]
            note(np.unique(np.concatenate([at[after[at] < n], left[left < n]])))
        alive = symbol[:n] >= 0
        word = np.repeat(np.arange(len(words)), lengths)
        return symbol[:n][alive].astype(np.int32), np.bincount(word[alive], minlength=len(words))

    def _codes(self, text: str) -> np.ndarray:
        if self.split is None or not any(s in text for s in self.special):
            return np.frombuffer(text.encode("utf-32-le"), np.uint32)
        number = {t: _STOP + 1 + k for k, t in enumerate(self.special)}
        return np.concatenate(
            [
                np.array([number[p]], np.uint32) if p in number else np.frombuffer(p.encode("utf-32-le"), np.uint32)
                for p in self.split.split(text)
            ]
        )

    def _slots(self, texts: list[str]) -> list[np.ndarray]:
        """The slots of the words of each text."""
        parts = [self._codes(t) for t in texts]
        cp = np.concatenate([x for p in parts for x in (p, np.array([_STOP], np.uint32))])
        start = token_bounds(cp)
        end = np.append(start[1:], len(cp))
        up, down = powers(len(cp) + 1)
        total = np.zeros(len(cp) + 1, np.uint64)
        np.cumsum(mix(cp.astype(np.uint64) + np.uint64(1)) * up[: len(cp)], out=total[1:])
        key = mix((total[end] - total[start]) * down[start])
        _, where, back = np.unique(key, return_index=True, return_inverse=True)
        # Equal keys must be equal words.
        size, model = end - start, where[back]
        same = size == size[model]
        inner = np.arange(len(cp)) - np.repeat(start, size)
        if not same.all() or (cp != cp[np.minimum(np.repeat(start[model], size) + inner, len(cp) - 1)]).any():
            where, back = np.arange(len(start)), np.arange(len(start))
        special = [f"\0{t}" for t in self.special]
        raw = cp[inner_index(start[where], size[where])]
        words = raw.copy()
        words[raw >= _STOP] = 0
        flat = words.tobytes().decode("utf-32-le")
        cut = np.concatenate([[0], np.cumsum(size[where])]).tolist()
        head = cp[start[where]].tolist()
        slot = self.slot
        ids = np.array(
            [
                slot[flat[a:b]] if h < _STOP else -1 if h == _STOP else slot[special[h - _STOP - 1]]
                for a, b, h in zip(cut, cut[1:], head, strict=False)
            ],
            np.int64,
        )
        got = ids[back]
        bounds = np.searchsorted(start, np.cumsum([len(p) + 1 for p in parts]) - 1)
        return [
            got[a:b].astype(np.int32) for a, b in zip([0, *(bounds[:-1] + 1).tolist()], bounds.tolist(), strict=True)
        ]

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text (int32)."""
        if len(self.slot) > TABLE_WORDS:
            self._clear()
        slots: list[np.ndarray] = []
        for a, b in spans([len(t) for t in texts], SPLIT_CHARS):
            slots += self._slots(texts[a:b])
        self._learn()
        out = []
        for s in slots:
            size = self.length[s]
            out.append(self.value[inner_index(self.first[s], size)])
        return out

    def decode_batch(self, ids: Iterable[np.ndarray]) -> list[str]:
        return [b"".join(map(self.token.__getitem__, x.tolist())).decode("utf-8", "replace") for x in ids]


def inner_index(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (size[0] of them), first[1], ..."""
    done = np.cumsum(size)
    return np.arange(done[-1] if len(done) else 0) + np.repeat(first - (done - size), size)


def spans(sizes, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of items with about ``limit`` in sum, one item at least."""
    total = np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64))])
    first = 0
    while first < len(total) - 1:
        last = max(first + 1, int(np.searchsorted(total, total[first] + limit, side="right")) - 1)
        yield first, last
        first = last


_loaded: dict[int, PairIndexBPE] = {}


def loaded(file: str) -> PairIndexBPE:
    """One table for each vocabulary and Python worker."""
    key = hash(file)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = PairIndexBPE(file)
    return _loaded[key]


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _blocks(batch: pa.RecordBatch, size) -> Iterator[pa.RecordBatch]:
    """Slices of about BLOCK_CHARS each."""
    for a, b in spans(size, BLOCK_CHARS):
        yield batch.slice(a, b - a)


def _without(batch: pa.RecordBatch, *names: str | None) -> tuple[list[pa.Array], list[str]]:
    keep = [x for x in batch.schema.names if x not in names]
    return [batch.column(batch.schema.get_field_index(x)) for x in keep], keep


def encode(
    docs: DataFrame,
    vocabulary: str,
    *,
    text: str = "text",
    ids: str = "ids",
    decoded: str | None = None,
) -> DataFrame:
    """docs with ``ids array<int>``. vocabulary: path of a JSON file, read on the driver (some MB).

    With ``decoded`` the ids are also decoded in the same Python worker, for round trips.
    """
    held = docs.sparkSession.sparkContext.broadcast(_read(vocabulary))
    schema = T.StructType(
        [
            *(f for f in docs.schema.fields if f.name not in (ids, decoded)),
            T.StructField(ids, T.ArrayType(T.IntegerType(), False), False),
            *([T.StructField(decoded, T.StringType(), False)] if decoded else []),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(held.value)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for part in _blocks(batch, np.diff(buffers(column)[1])):
                got = bpe.encode_batch([x or "" for x in part.column(batch.schema.get_field_index(text)).to_pylist()])
                off = np.concatenate([[0], np.cumsum([len(x) for x in got])]).astype(np.int32)
                made = [pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(got)))]
                if decoded:
                    made.append(pa.array(bpe.decode_batch(got), pa.string()))
                columns, names = _without(part, ids, decoded)
                yield pa.RecordBatch.from_arrays(
                    [*columns, *made],
                    names=[*names, ids, *([decoded] if decoded else [])],
                )

    return docs.mapInArrow(released(run), schema)


def decode(rows: DataFrame, vocabulary: str, *, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """rows with ``decoded string``, the text of ``ids``; null ids give an empty text. An id outside
    the vocabulary is an error."""
    held = rows.sparkSession.sparkContext.broadcast(_read(vocabulary))
    schema = T.StructType(
        [*(f for f in rows.schema.fields if f.name != decoded), T.StructField(decoded, T.StringType(), False)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(held.value)
        for batch in batches:
            k = batch.schema.get_field_index(ids)
            for part in _blocks(batch, batch.column(k).value_lengths().fill_null(0).to_numpy(zero_copy_only=False) * 4):
                column = part.column(k)
                made = pa.array(
                    bpe.decode_batch(
                        x.values.to_numpy(zero_copy_only=False) if x.is_valid else np.zeros(0, np.int32) for x in column
                    ),
                    pa.string(),
                )
                columns, names = _without(part, decoded)
                yield pa.RecordBatch.from_arrays([*columns, made], names=[*names, decoded])

    return rows.mapInArrow(released(run), schema)
