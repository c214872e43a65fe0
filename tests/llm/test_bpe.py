"""Encoding and decoding against the tokenizers library."""

import json
import random
from pathlib import Path

import pytest
from tokenizers import Tokenizer

from domscope.llm import bpe
from domscope.llm.queries import vocabulary_path

SCHEMA = "doc_id long, text string, ids string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def mine():
    with open(vocabulary_path(), encoding="utf-8") as f:
        return bpe.PairIndexBPE(f.read())


def _texts():
    rng = random.Random(1)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    out = [
        "",
        " ",
        "a",
        "<|endoftext|>",
        "x <|endoftext|> y<|endoftext|><|endoftext|>z",
        " \n\n  a b  c\x1c\x1d d​﻿ \x85 z",
        "it's they'LL I'm 'sss ''s 'rest 'x 'd've",
        "aaaa aaaaaaa ======= \t\tx",
        "a\r\n\r\nb  ",
        "你好 🤦🏼‍♂️ ½ Ⅷ² 12３４",
        "\x00\x01\0<|endoftext|>",
    ]
    out += ["".join(chr(rng.choice(points[:0x3000] if k % 2 else points)) for _ in range(200)) for k in range(100)]
    out += ["".join(rng.choice("ab' \n1.sltrvedm") for _ in range(80)) for _ in range(300)]
    out += [f"a {chr(c)}b{chr(c)}  {chr(c)}{chr(c)} 1" for c in points[:0x2100]]
    return out


def test_against_library(library, mine):
    texts = _texts()
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = mine.encode_batch(texts)
    assert [x.tolist() for x in got] == expected
    assert mine.decode_batch(got) == [library.decode(x, skip_special_tokens=False) for x in expected]


def test_arbitrary_ids_decode(library, mine):
    import numpy as np

    rng = random.Random(2)
    for _ in range(200):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(30))]
        assert mine.decode_batch([np.array(ids, np.int32)])[0] == library.decode(ids, skip_special_tokens=False)


def test_small_table_and_blocks(library, monkeypatch):
    monkeypatch.setattr(bpe, "TABLE_WORDS", 5)
    monkeypatch.setattr(bpe, "SPLIT_CHARS", 40)
    with open(vocabulary_path(), encoding="utf-8") as f:
        own = bpe.PairIndexBPE(f.read())
    for texts in (["one two three four five six seven"] * 3, ["one eight nine", "", "x" * 500], ["ten"]):
        assert [x.tolist() for x in own.encode_batch(texts)] == [
            e.ids for e in library.encode_batch(texts, add_special_tokens=False)
        ]


def test_frames(spark, library):
    rows = [
        (1, "Hello  world", "old"), (2, None, None), (3, "", "x"), (1, "Hello  world", "old"), (None, "tie tie", "x"),
        (5, "long " * 20_000, "x"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    path = vocabulary_path()
    both = bpe.encode(docs, path, decoded="decoded").collect()
    split = bpe.decode(bpe.encode(docs, path), path).collect()
    assert sorted(map(repr, both)) == sorted(map(repr, split))
    for r in both:
        text = next(t for d, t, _ in rows if d == r["doc_id"])
        assert r["ids"] == library.encode(text or "", add_special_tokens=False).ids
        assert r["decoded"] == (text or "")
    empty = spark.createDataFrame([], SCHEMA)
    assert bpe.decode(bpe.encode(empty, path), path).collect() == []


@pytest.mark.parametrize(
    "change",
    [
        {"normalizer": {"type": "NFC"}},
        {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}},
        {"pre_tokenizer": None},
    ],
)
def test_other_files_are_refused(change):
    spec = json.loads(Path(vocabulary_path()).read_text(encoding="utf-8"))
    bpe.PairIndexBPE(json.dumps(spec))
    with pytest.raises(ValueError, match="not supported"):
        bpe.PairIndexBPE(json.dumps(spec | change))
