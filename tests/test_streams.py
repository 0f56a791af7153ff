"""Incremental loads."""

import glob
import json
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import lakeweir as lw
from tests.helpers import rows


def drop(tmp_path, name, *records, fmt="json"):
    """Put one file into the landing folder."""
    place = tmp_path / "in" / "2024" / "01"
    place.mkdir(parents=True, exist_ok=True)
    if fmt == "json":
        text = "\n".join(json.dumps(r) for r in records)
    else:
        text = "\n".join([",".join(records[0]), *[",".join(map(str, r.values())) for r in records]])
    (place / name).write_text(text + "\n")


def run(spark, tmp_path, fmt="json", **how):
    stream = lw.file_stream(spark, f"{tmp_path}/in", fmt, f"{tmp_path}/schema", **how)
    return lw.append_stream(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint")


def out(spark, tmp_path):
    schema = lw.load_schema(spark, f"{tmp_path}/schema")
    return spark.read.schema(schema).parquet(f"{tmp_path}/out")


def test_each_file_is_loaded_once(spark, tmp_path):
    drop(tmp_path, "a.json", {"id": 1, "v": "x"})
    run(spark, tmp_path)
    drop(tmp_path, "b.json", {"id": 2, "v": "y"}, {"id": 2, "v": "y"})
    run(spark, tmp_path)
    expected = {(1, "x"): 1, (2, "y"): 2}
    assert rows(out(spark, tmp_path)) == expected
    run(spark, tmp_path)
    assert rows(out(spark, tmp_path)) == expected
    batch = lw.read_path(spark, f"{tmp_path}/in", "json", recursive=True)
    assert rows(batch) == expected


def test_new_columns_join_between_runs(spark, tmp_path):
    drop(tmp_path, "a.json", {"id": 1})
    run(spark, tmp_path)
    drop(tmp_path, "b.json", {"id": 2, "v": "y"})
    run(spark, tmp_path)
    assert rows(out(spark, tmp_path)) == {(1, None): 1, (2, "y"): 1}


def test_values_that_a_stored_type_cannot_hold_are_refused(spark, tmp_path):
    drop(tmp_path, "a.json", {"id": 1})
    run(spark, tmp_path)
    drop(tmp_path, "b.json", {"id": 2.5, "x": True})
    with pytest.raises(ValueError, match="double in id, which is stored as bigint"):
        run(spark, tmp_path)
    assert rows(out(spark, tmp_path)) == {(1,): 1}


def test_narrower_and_blank_columns_keep_the_stored_type(spark, tmp_path):
    drop(tmp_path, "a.json", {"id": 1.5, "n": 1})
    run(spark, tmp_path)
    drop(tmp_path, "b.json", {"id": 2, "n": None})
    run(spark, tmp_path)
    assert lw.load_schema(spark, f"{tmp_path}/schema").simpleString() == "struct<id:double,n:bigint>"
    assert rows(out(spark, tmp_path)) == {(1.5, 1): 1, (2.0, None): 1}


def test_structs_gain_fields(spark, tmp_path):
    drop(tmp_path, "a.json", {"s": {"a": 1}})
    run(spark, tmp_path)
    drop(tmp_path, "b.json", {"s": {"a": 2, "b": "x"}})
    run(spark, tmp_path)
    schema = lw.load_schema(spark, f"{tmp_path}/schema")
    assert schema.simpleString() == "struct<s:struct<a:bigint,b:string>>"
    got = spark.read.schema(schema).parquet(f"{tmp_path}/out").select("s.a", "s.b")
    assert rows(got) == {(1, None): 1, (2, "x"): 1}


def test_a_restart_in_another_zone_finds_new_columns(spark, tmp_path, conf):
    conf("spark.sql.session.timeZone", "Asia/Tokyo")
    drop(tmp_path, "a.json", {"id": 1})
    run(spark, tmp_path)
    conf("spark.sql.session.timeZone", "America/Los_Angeles")
    drop(tmp_path, "b.json", {"id": 2, "w": 3})
    run(spark, tmp_path)
    assert lw.load_schema(spark, f"{tmp_path}/schema").names == ["id", "w"]


def test_streams_into_one_path_keep_apart(spark, tmp_path):
    drop(tmp_path, "a.csv", {"id": 1, "v": 2}, fmt="csv")
    lw.ingest_stream(spark, spec(tmp_path))
    lw.ingest_stream(spark, spec(tmp_path, checkpoint=f"{tmp_path}/other"))
    assert rows(lw.read_increments(spark, f"{tmp_path}/out", TARGET)) == {(1, 2): 2}


def test_counts_outlast_the_progress_that_spark_keeps(spark, tmp_path, conf):
    conf("spark.sql.streaming.numRecentProgressUpdates", "1")
    for i in range(4):
        drop(tmp_path, f"{i}.csv", {"id": i, "v": 2}, fmt="csv")
    plain = spec(tmp_path, target_schema=None, schema="id int, v int", max_files=1)
    assert lw.ingest_stream(spark, plain).source_count == 4


def test_later_runs_infer_from_new_files_only(spark, tmp_path):
    drop(tmp_path, "a.json", {"id": 1})
    run(spark, tmp_path)
    import os

    first = tmp_path / "in" / "2024" / "01" / "a.json"
    os.utime(first, (1_600_000_000, 1_600_000_000))
    shutil.copy(first, tmp_path / "kept.json")
    first.write_text("no json at all")
    os.utime(first, (1_600_000_000, 1_600_000_000))
    drop(tmp_path, "b.json", {"id": 2})
    schema = lw.evolve_schema(spark, f"{tmp_path}/in", "json", f"{tmp_path}/schema")
    assert schema.fieldNames() == ["id"], "the old file is not looked at again"


def test_types_are_inferred_or_left_as_text(spark, tmp_path):
    drop(tmp_path, "a.csv", {"the id": 1, "v": 2.5}, fmt="csv")
    typed = lw.file_stream(spark, f"{tmp_path}/in", "csv", f"{tmp_path}/s1")
    text = lw.file_stream(spark, f"{tmp_path}/in", "csv", f"{tmp_path}/s2", infer_types=False)
    assert typed.schema.simpleString() == "struct<the id:int,v:double>"
    assert text.schema.simpleString() == "struct<the id:string,v:string>"
    run(spark, tmp_path, "csv")
    assert spark.read.parquet(f"{tmp_path}/out").columns == ["theid", "v"]


def test_documents_over_several_lines(spark, tmp_path):
    drop(tmp_path, "a.json", {"id": 0})
    place = tmp_path / "in" / "2024" / "01" / "a.json"
    place.write_text('[\n{"id": 1,\n "v": [1, 2]},\n{"id": 2, "v": []}\n]')
    run(spark, tmp_path, multiline=True)
    assert sorted((r["id"], list(r["v"])) for r in out(spark, tmp_path).collect()) == [
        (1, [1, 2]),
        (2, []),
    ]


def test_a_backlog_is_loaded_in_bounded_steps(spark, tmp_path):
    for i in range(5):
        drop(tmp_path, f"{i}.json", {"id": i})
    query = run(spark, tmp_path, max_files=2)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert out(spark, tmp_path).count() == 5


def test_an_empty_landing_folder_is_reported(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with pytest.raises(ValueError, match="no files"):
        run(spark, tmp_path)


def test_a_failed_increment_is_raised(spark, tmp_path):
    drop(tmp_path, "a.json", {"id": 1})
    stream = lw.file_stream(spark, f"{tmp_path}/in", "json", f"{tmp_path}/schema")

    def fail(batch, batch_id):
        raise RuntimeError("stop here")

    with pytest.raises(Exception, match="stop here"):
        lw.append_stream(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", fail)


def test_records_that_do_not_fit_can_be_kept_as_text(spark, tmp_path):
    drop(tmp_path, "a.csv", {"id": 1, "v": 2}, {"id": 3, "v": "x"}, fmt="csv")
    lw.ingest_stream(
        spark,
        lw.StreamSpec(
            source=f"{tmp_path}/in",
            fmt="csv",
            path=f"{tmp_path}/out",
            checkpoint=f"{tmp_path}/checkpoint",
            schema="id int, v int",
            corrupt_column="_raw",
        ),
    )
    found = spark.read.parquet(f"{tmp_path}/out").select("id", "v", "_raw")
    assert rows(found) == {(1, 2, None): 1, (3, None, "3,x"): 1}


def test_parquet_streams_find_columns_in_any_file(spark, tmp_path):
    spark.sql("SELECT 1 AS a").write.parquet(f"{tmp_path}/in/1")
    spark.sql("SELECT 2 AS a, 'x' AS b").write.parquet(f"{tmp_path}/in/2")
    run(spark, tmp_path, "parquet")
    assert rows(out(spark, tmp_path)) == {(1, None): 1, (2, "x"): 1}


def test_validated_json_is_read_as_text(spark, tmp_path):
    drop(tmp_path, "a.json", {"id": 1, "v": 2}, {"id": 2, "v": "two"}, {"id": 3})
    load = spec(tmp_path, reject_path=f"{tmp_path}/bad")
    load.fmt = "json"
    result = lw.ingest_stream(spark, load)
    assert (result.transform_count, result.reject_count) == (2, 1)
    found = lw.read_increments(spark, f"{tmp_path}/out", TARGET)
    assert rows(found) == {(1, 2): 1, (3, None): 1}


# --- validation --------------------------------------------------------------

TARGET = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("v", T.IntegerType())]
)


def spec(tmp_path, **more):
    settings = {
        "source": f"{tmp_path}/in",
        "fmt": "csv",
        "path": f"{tmp_path}/out",
        "checkpoint": f"{tmp_path}/checkpoint",
        "schema_path": f"{tmp_path}/schema",
        "target_schema": TARGET,
    }
    return lw.StreamSpec(**(settings | more))


def test_increments_are_split_into_good_and_bad(spark, schema, tmp_path):
    more = {
        "reject_path": f"{tmp_path}/bad",
        "history_root": f"{tmp_path}/history",
        "table": f"{schema}.t",
    }
    drop(tmp_path, "a.csv", {"id": 1, "v": 2}, {"id": 2, "v": "two"}, fmt="csv")
    first = lw.ingest_stream(spark, spec(tmp_path, batch_id="one", **more))
    drop(tmp_path, "b.csv", {"id": 3, "v": 4}, fmt="csv")
    second = lw.ingest_stream(spark, spec(tmp_path, batch_id="two", **more))
    third = lw.ingest_stream(spark, spec(tmp_path, batch_id="three", **more))

    assert (first.source_count, first.transform_count, first.reject_count) == (2, 1, 1)
    assert (second.source_count, second.transform_count, second.reject_count) == (1, 1, 0)
    assert third.source_count == 0
    expected = {(1, 2): 1, (3, 4): 1}
    assert rows(lw.read_increments(spark, f"{tmp_path}/out", TARGET)) == expected
    assert rows(spark.table(f"{schema}.t")) == expected
    (bad,) = spark.read.parquet(f"{tmp_path}/bad").collect()
    assert bad["id"] == 2 and bad["rejected_values"][0]["value"] == "two"
    history = lw.load_history(spark, f"{tmp_path}/history")
    (folder,) = glob.glob(f"{tmp_path}/out/stream=*")
    stream = folder.rsplit("=", 1)[1]
    assert rows(history.select("load_id", "rows_out")) == {(f"{stream}-0", 1): 1, (f"{stream}-1", 1): 1}


def test_bad_rows_without_a_place_stop_the_load(spark, tmp_path):
    drop(tmp_path, "a.csv", {"id": 1, "v": "one"}, fmt="csv")
    with pytest.raises(Exception, match="no reject_path"):
        lw.ingest_stream(spark, spec(tmp_path))
    assert not glob.glob(f"{tmp_path}/out/*")


def test_a_replayed_increment_leaves_one_copy(spark, tmp_path):
    write = lw.validated_append(f"{tmp_path}/out", TARGET, dedupe=True)
    batch = spark.createDataFrame([(1, 2), (1, 2)], "id int, v int")
    for _ in range(2):
        write(batch, 7)
    write(batch.limit(0), 8)
    assert rows(lw.read_increments(spark, f"{tmp_path}/out", TARGET)) == {(1, 2): 1}
    assert glob.glob(f"{tmp_path}/out/*/*") == [f"{tmp_path}/out/stream=stream/batch_id=7"]


def test_stream_load_registers_a_growing_table(spark, schema, tmp_path):
    load = lambda: lw.ingest_stream(
        spark,
        lw.StreamSpec(
            source=f"{tmp_path}/in",
            fmt="json",
            path=f"{tmp_path}/out",
            checkpoint=f"{tmp_path}/checkpoint",
            schema_path=f"{tmp_path}/schema",
            table=f"{schema}.t",
            history_root=f"{tmp_path}/history",
        ),
    )
    drop(tmp_path, "a.json", {"the id": 1})
    assert load().source_count == 1
    drop(tmp_path, "b.json", {"the id": 2, "v": "y"})
    assert load().source_count == 1
    assert load().source_count == 0
    assert rows(spark.table(f"{schema}.t")) == {(1, None): 1, (2, "y"): 1}
    assert spark.table(f"{schema}.t").columns == ["theid", "v"]
    assert lw.table_count(spark, f"{schema}.t").collect()[0]["rows"] == 2
    assert lw.load_history(spark, f"{tmp_path}/history").count() == 3


def merging(tmp_path, schema, **more):
    how = {"merge": "newest", "keys": "id", "recency": "at", "schema": "id int, at int, v string"}
    return lw.StreamSpec(
        source=f"{tmp_path}/in", fmt="json", path=f"{tmp_path}/versions", checkpoint=f"{tmp_path}/checkpoint",
        table=f"{schema}.t", history_root=f"{tmp_path}/history", **(how | more),
    )


def test_increments_are_merged_once(spark, schema, tmp_path, monkeypatch):
    load = merging(tmp_path, schema, dedupe_batch=True)
    (tmp_path / "in").mkdir()
    assert lw.ingest_stream(spark, load).raw_count == 0 and not spark.catalog.tableExists(load.table)
    drop(tmp_path, "a.json", {"id": 1, "at": 5, "v": "a"}, {"id": 1, "at": 4, "v": "older"}, {"id": 2, "at": 5, "v": "b"}, {"at": 9, "v": "no key"})
    assert lw.ingest_stream(spark, load).operation == "stream merge"
    drop(tmp_path, "b.json", {"id": 1, "at": 3, "v": "late"}, {"id": 2, "at": 6, "v": "B"}, {"id": 3, "v": "undated"})
    expected = {(1, 5, "a"): 1, (2, 6, "B"): 1, (3, None, "undated"): 1, (None, 9, "no key"): 1}

    # The second increment fails when its version is written and the table not yet moved to it.
    from lakeweir.sources import tables

    monkeypatch.setattr(tables, "exceeds_bound", lambda df, n: F.lit(True))
    with pytest.raises(Exception, match="characters"):
        lw.ingest_stream(spark, load)
    monkeypatch.undo()
    lw.ingest_stream(spark, load)
    assert rows(spark.table(load.table)) == expected
    # It is published, but its commit is lost: it comes again and is left out.
    version = tables.table_location(spark, load.table)
    for name in ("1", ".1.crc"):
        shutil.move(f"{tmp_path}/checkpoint/commits/{name}", f"{tmp_path}/lost-{name}")
    lw.ingest_stream(spark, load)
    assert rows(spark.table(load.table)) == expected
    assert tables.table_location(spark, load.table) == version
    assert lw.load_history(spark, f"{tmp_path}/history").count() == 2


def test_merging_streams_need_sound_settings(spark, schema, tmp_path):
    for wrong in ({"merge": "best"}, {"keys": ""}, {"table": None}, {"dedupe": True}, {"dedupe_batch": True, "recency": ""}, {"merge": None}):
        load = merging(tmp_path, schema)
        for name, value in wrong.items():
            setattr(load, name, value)
        with pytest.raises(ValueError):
            lw.ingest_stream(spark, load)
