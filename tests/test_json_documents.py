"""JSON documents read in byte ranges, against the json module."""

import contextlib
import io
import json
import random

import pytest
from conftest import SF_SMALL, rows

from lendlayer.plans import queries as Q
from lendlayer.sources.files import read_json

DDL = "id string, x double, note string, inner struct<a: int, b: array<string>>"


@pytest.fixture()
def small_ranges(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    saved = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "700")
    spark.conf.set(keys[1], "1")
    yield spark
    for k, v in saved.items():
        spark.conf.set(k, v)


def objects(seed, n):
    rng = random.Random(seed)
    notes = ["", "plain", 'quote " in', "}", "}}]{[", '\\', '\\"}', "é{日本", "a\nb", '"}, {"id": "fake"', None, "x" * 900 + "}" * 5]
    out = []
    for i in range(n):
        o = {"id": f"L{i}", "x": i / 4, "note": rng.choice(notes)}
        if rng.random() < 0.5:
            o["inner"] = {"a": i, "b": [rng.choice(["]", "}", "{", '"']) for _ in range(rng.randint(0, 3))]}
        out.append(o)
    return out


def expected(docs):
    return sorted(((d["id"], d["x"], d["note"], (d["inner"]["a"], d["inner"]["b"]) if "inner" in d else None) for d in docs), key=str)


def got(df):
    return sorted(((r.id, r.x, r.note, (r.inner.a, r.inner.b) if r.inner else None) for r in df.collect()), key=str)


@pytest.mark.parametrize("form", [dict(indent=2), dict(), dict(indent=None, separators=(",", ":"), ensure_ascii=False)])
def test_array_in_many_ranges(small_ranges, tmp_path, form):
    files = [objects(1, 150), objects(2, 3), []]
    for i, docs in enumerate(files):
        (tmp_path / f"f{i}.json").write_text(json.dumps(docs, **form), encoding="utf-8", newline="")
    df = read_json(small_ranges, str(tmp_path), DDL)
    assert got(df) == expected(files[0] + files[1])
    ranges = small_ranges.read.option("lineSep", "}").text(str(tmp_path / "f0.json"))
    assert ranges.rdd.getNumPartitions() > 20  # one file, many tasks


def test_other_documents(small_ranges, tmp_path):
    docs = objects(3, 40)
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(d) for d in docs) + "\n")
    (tmp_path / "one.json").write_text("﻿ " + json.dumps({"id": "single", "x": 1.0, "note": None}, indent=1), encoding="utf-8")
    (tmp_path / "mixed.json").write_text('[1, null, {"id": "m", "x": 2.5, "note": "}"}, "{}"]')
    df = read_json(small_ranges, str(tmp_path), DDL)
    assert got(df) == expected(docs + [{"id": "single", "x": 1.0, "note": None}, {"id": "m", "x": 2.5, "note": "}"}])


def test_broken_objects_harm_no_neighbour(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": "a", "x": 1}, {"id": oops}, {}, {"id": "b", "x": "text"}]')
    (tmp_path / "b.json").write_text('{"id": "c", "x": 3')
    (tmp_path / "empty.json").write_text("")
    found = [tuple(r)[:2] for r in read_json(spark, str(tmp_path), DDL).collect()]
    assert ("a", 1.0) in found and ("b", None) in found and len(found) == 5
    assert rows(read_json(spark, str(tmp_path / "a.json"), "id string").filter("id is not null")) == [("a",), ("b",)]


def test_text_is_not_shuffled(spark, tmp_path):
    """Pieces stay with the task that reads them; only range summaries and objects of several ranges move."""
    (tmp_path / "a.json").write_text(json.dumps(objects(4, 20)))
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        read_json(spark, str(tmp_path), DDL).explain()
    moves = [ln for ln in shown.getvalue().splitlines() if "Exchange hashpartitioning" in ln]
    assert moves and not any("block#" in ln.split("ENSURE")[0] for ln in moves)


def test_escapes_at_the_edges_of_pieces(small_ranges, tmp_path):
    """Backslashes before braces and quotes, in files of many ranges and files of one."""
    texts = ["\\" * n + end for n in range(4) for end in ("}", '"', '"}', "}\\", '{"', "")]
    docs = [{"id": f"L{i}", "x": i / 4, "note": rest} for i, rest in enumerate(texts * 8)]
    (tmp_path / "many.json").write_text(json.dumps(docs, indent=1))
    for d in docs[:10]:
        (tmp_path / f"{d['id']}.json").write_text(json.dumps(d))
    assert got(read_json(small_ranges, str(tmp_path), DDL)) == expected(docs + docs[:10])


def test_the_landed_array_is_one_file(spark, tmp_path, monkeypatch):
    """The objects are made by many tasks, but the file is one document."""
    monkeypatch.setattr(Q, "scratch_path", lambda spark, tag: str(tmp_path / tag))
    landed = rows(Q.json_multiline(spark, SF_SMALL).select("loan_id", "remark"))
    [file] = (tmp_path / "jsonarray" / "landing" / "loan_array").glob("part-*")
    assert sorted((o["loan_id"], o["remark"]) for o in json.loads(file.read_text())) == landed
