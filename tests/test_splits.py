"""Files that are read in many splits give the rows and ordinals of one reader."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import types as T

from domscope.sources import files, splits

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType())])


@pytest.fixture
def small_splits(spark):
    had = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "499")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in had.items():
        spark.conf.set(k, v)


def _through(grammar, text, cuts):
    """Records by splits of the pieces at these cuts."""
    pieces = text.split(grammar.separator)
    pieces = pieces[:-1] if pieces[-1] == "" else pieces
    at = sorted({0, len(pieces), *(c % (len(pieces) + 1) for c in cuts)})
    state, before, whole, parts = grammar.first, 0, {}, {}
    for a, b in zip(at, at[1:], strict=False):
        for k, value, done in grammar.records(iter(pieces[a:b]), state):
            if done:
                assert before + k not in whole
                whole[before + k] = value
            else:
                parts.setdefault(before + k, []).append(value)
        state, begun = grammar.follow(state, json.loads(json.dumps(grammar.summary(iter(pieces[a:b])))))
        before += begun
    assert not whole.keys() & parts.keys()
    whole |= {k: grammar.separator.join(v) for k, v in parts.items()}
    assert sorted(whole) == list(range(before))
    return [whole[k] for k in sorted(whole)]


def test_csv_states_against_the_csv_module():
    rng = random.Random(1)
    for _ in range(1500):
        text = "".join(rng.choice('ab",\n"\n,') for _ in range(rng.randrange(60)))
        got = _through(splits.Csv(), text, [rng.randrange(100) for _ in range(rng.randrange(5))])
        assert got == _through(splits.Csv(), text, [])
        if splits.Csv().summary(iter(text.split("\n")))[0][0] == 0:  # a cell that is open at the end has lost its last line end
            want = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
            assert [files._cells(x) for x in got] == want


def _value(rng, depth):
    kind = rng.random()
    if depth <= 0 or kind < 0.35:
        return rng.choice([1, None, True, "a,b", 'q"u\\"o[te', "x]{", "\\", 2.5, "é,", "field", ""])
    if kind < 0.6:
        return [_value(rng, depth - 1) for _ in range(rng.randrange(4))]
    return {rng.choice(["k", "field", "a,b", '"x']): _value(rng, depth - 1) for _ in range(rng.randrange(4))}


def test_json_states_against_the_json_module():
    rng = random.Random(2)
    for _ in range(1500):
        rows = [_value(rng, 3) for _ in range(rng.randrange(6))]
        style = {"indent": rng.choice([None, 2]), "separators": rng.choice([None, (",", ":")])}
        cuts = [rng.randrange(100) for _ in range(rng.randrange(6))]
        assert [json.loads(x) for x in _through(splits.Json(), json.dumps(rows, **style), cuts)] == rows
        items = [(rng.choice("abcxyz"), _value(rng, 2)) for _ in range(3)] + [("field", rows)]
        rng.shuffle(items)
        found = _through(splits.Json("field"), json.dumps(dict(items), **style), cuts)
        assert [json.loads(x) for x in found] == rows


def _table(rng, n):
    cell = lambda: "".join(rng.choice('xyz,"\n é') for _ in range(rng.randrange(12)))
    return [{"id": str(i), "a": cell(), "b": cell()} for i in range(n)]


def _csv(path, rows, header=("id", "a", "b"), end="\r\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.DictWriter(f, fieldnames=header, lineterminator=end)
        out.writeheader()
        out.writerows(rows)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_a_csv_file_of_many_splits(spark, small_splits, tmp_path, end):
    rows = _table(random.Random(3), 120)
    rows[50]["a"] = "a cell\n" * 200  # over several splits
    _csv(tmp_path / "t.csv", rows, end=end)
    path = str(tmp_path / "t.csv")
    assert spark.read.text(path).rdd.getNumPartitions() > 5 and not splits.one_split(spark, path)
    got = files.csv_table(spark, path, ["id", "b", "gone"]).orderBy("ordinal").collect()
    assert [(r.id, r.a, r.b, r.gone, r.ordinal) for r in got] == [(r["id"], r["a"], r["b"], "", k) for k, r in enumerate(rows, 1)]


def test_a_folder_of_csv_files_is_numbered_by_path(spark, small_splits, tmp_path):
    rows = _table(random.Random(4), 90)
    (tmp_path / "f").mkdir()
    for k, part in enumerate((rows[:10], rows[10:80], [], rows[80:])):
        _csv(tmp_path / "f" / f"{k}.csv", part)
    (tmp_path / "f" / "9.csv").write_text("")
    got = files.csv_table(spark, str(tmp_path / "f"), ["id"]).orderBy("ordinal").collect()
    assert [(r.id, r.a, r.ordinal) for r in got] == [(r["id"], r["a"], k) for k, r in enumerate(rows, 1)]
    _csv(tmp_path / "f" / "5.csv", [{"id": "1"}], header=("id",))
    with pytest.raises(Exception, match="different headers"):
        files.csv_table(spark, str(tmp_path / "f"), ["id"]).collect()


def test_csv_edges(spark, tmp_path):
    texts = {
        "bom": "﻿id,a\n1,x\n", "blank": "\n\nid,a\n\n1,x\n\n", "only": "id,a\n", "none": "", "last": 'id,a\n1,"open\ncell',
        "twice": "id,a,id\n1,x,2\n", "wide": "id,a\n1,x,more\n2\n", "bare": "id,a\n1,x\ry\n",
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8", newline="")
    read = lambda n: [(r.id, r.a, r.ordinal) for r in files.csv_table(spark, str(tmp_path / f"{n}.csv"), ["id", "a"]).orderBy("ordinal").collect()]
    assert read("bom") == read("blank") == [("1", "x", 1)]
    assert read("only") == read("none") == read("absent") == []
    assert read("last") == [("1", "open\ncell", 1)]
    assert read("twice") == [("2", "x", 1)]
    assert read("wide") == [("1", "x", 1), ("2", "", 2)]
    assert read("bare") == [("1", "x y", 1)]
    (tmp_path / "broken.csv").write_bytes(b"id,a\n1,\xff\n")
    assert read("broken") == [("1", "�", 1)]


@pytest.mark.parametrize("indent", [None, 2])
def test_a_json_document_of_many_splits(spark, small_splits, tmp_path, indent):
    rows = [{"k": f'a,"{i}[', "n": i, "more": {"field": [i, {"x": "]"}]}} for i in range(60)]
    rows[40]["k"] = "long, " * 300
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=indent), encoding="utf-8")
    doc = {"before": [{"k": "no"}] * 30, "field": rows, "z": {"field": [{"k": "no"}]}}
    (tmp_path / "o.json").write_text(json.dumps(doc, indent=indent), encoding="utf-8")
    for name, field in (("a", None), ("o", "field")):
        got = files.json_rows(spark, str(tmp_path / f"{name}.json"), SCHEMA, field).orderBy("ordinal").collect()
        assert [(r.k, r.n, r.ordinal) for r in got] == [(r["k"], r["n"], k) for k, r in enumerate(rows)]
        whole = files.json_elements(spark, str(tmp_path / f"{name}.json"), field).orderBy("ordinal").collect()
        assert [json.loads(r.value) for r in whole] == rows


def test_json_edges(spark, tmp_path):
    texts = {"empty": "[]", "gap": " [ \n ] ", "none": "", "other": '{"x": [1]}', "mixed": '[1, {"k": "a"}, null, [2], {"k": 3, "z": 1}]'}
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    read = lambda n, f=None: [tuple(r) for r in files.json_rows(spark, str(tmp_path / f"{n}.json"), SCHEMA, f).orderBy("ordinal").collect()]
    assert read("empty") == read("gap") == read("none") == read("other", "field") == read("absent") == []
    assert read("mixed") == [(None, None, 0), ("a", None, 1), (None, None, 2), (None, None, 3), ("3", None, 4)]


def test_a_split_that_is_cut_otherwise_is_an_error(spark, small_splits, tmp_path, monkeypatch):
    _csv(tmp_path / "t.csv", _table(random.Random(5), 60))
    states = splits.split_states

    def moved(*args):
        found, paths = states(*args)
        return found.withColumn("length", found["length"] + 1), paths

    monkeypatch.setattr(splits, "split_states", moved)
    with pytest.raises(Exception, match="cut otherwise"):
        files.csv_table(spark, str(tmp_path / "t.csv"), ["id"]).collect()
