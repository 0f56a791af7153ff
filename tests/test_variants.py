"""JSON columns that come without a schema."""

import json

import pytest

import lakeweir as lw

ROWS = [
    (1, '{"k": 1, "name": "a", "at": {"x": 1, "y": [1, 2]}}'),
    (2, '{"k": 5000000000, "name": null}'),
    (3, '{"k": 2, "more": {"deep": true}, "odd name": 1.5}'),
    (4, None),
    (5, "no json"),
    (6, "[1, 2]"),
    (7, "{}"),
    (8, '{"k": 3, "mixed": 1}'),
    (9, '{"mixed": "one", "nothing": null}'),
]


@pytest.fixture
def frame(spark):
    return lambda rows: spark.createDataFrame(rows, "id int, j string")


def test_the_schema_covers_all_rows(frame):
    schema = lw.infer_json_schema(frame(ROWS), "j")
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    assert set(kinds) == {"k", "name", "at", "more", "odd name", "mixed", "nothing"}
    assert kinds["k"] == "bigint" and kinds["name"] == "string" and kinds["mixed"] == kinds["nothing"] == "string"
    assert kinds["at"] == "struct<x:bigint,y:array<bigint>>" and kinds["more"] == "struct<deep:boolean>"


def test_typed_values_and_what_is_no_object(frame):
    got = {r["id"]: r for r in lw.open_json(frame(ROWS), "j").collect()}
    assert len(got) == len(ROWS)
    assert got[1]["j"]["k"] == 1 and got[1]["j"]["at"]["y"] == [1, 2] and got[2]["j"]["k"] == 5_000_000_000
    assert got[3]["j"]["more"]["deep"] is True and float(got[3]["j"]["odd name"]) == 1.5
    assert got[8]["j"]["mixed"] == "1" and got[9]["j"]["mixed"] == "one"
    assert got[5]["j_rest"] == "no json" and got[6]["j_rest"] == "[1, 2]"
    assert all(got[i]["j_rest"] is None for i in (1, 2, 3, 4, 7, 8, 9))


def test_later_runs_read_by_the_stored_schema_and_lose_nothing(frame, tmp_path):
    path = str(tmp_path / "schema")
    first = lw.open_json(frame([(1, '{"k": 1, "n": "x"}')]), "j", path)
    assert [tuple(r) for r in first.collect()] == [(1, (1, "x"), None)]
    later = frame([(2, '{"k": 2, "new": {"a": [1, "b"]}}'), (3, '{"k": "text", "n": "y"}'), (4, '{"k": null}')])
    got = {r["id"]: r for r in lw.open_json(later, "j", path).collect()}
    assert got[2]["j"]["k"] == 2 and json.loads(got[2]["j_rest"]) == {"new": {"a": [1, "b"]}}
    assert got[3]["j"]["k"] is None and got[3]["j"]["n"] == "y" and json.loads(got[3]["j_rest"]) == {"k": "text"}
    assert got[4]["j_rest"] is None
    assert lw.load_schema(later.sparkSession, path) == lw.infer_json_schema(frame([(1, '{"k": 1, "n": "x"}')]), "j")


def test_flattening_what_was_opened(frame):
    flat = lw.flatten(lw.open_json(frame(ROWS[:2]), "j"), explode=False)
    assert flat.columns == ["id", "j_at_x", "j_at_y", "j_k", "j_name", "j_rest"]


def test_nothing_to_learn_from(frame):
    for rows in ([], [(1, "no json"), (2, None), (3, "{}")]):
        opened = lw.open_json(frame(rows), "j")
        assert opened.columns == ["id", "j_rest"]
        assert {r["id"]: r["j_rest"] for r in opened.collect()} == {1: "no json", 2: None, 3: None} if rows else True
    with pytest.raises(ValueError, match="share a name"):
        lw.open_json(frame(ROWS), "j", rest="ID")
    with pytest.raises(ValueError, match="has no column"):
        lw.infer_json_schema(frame(ROWS), "x")
