"""Complete batch loads."""

import datetime as dt
import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import lakeweir as lw
from lakeweir.sources.tables import partition_columns
from tests.helpers import rows, staged_folders

AT = dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc)


def land(tmp_path, name, text):
    place = tmp_path / "raw" / "acme"
    place.mkdir(parents=True, exist_ok=True)
    (place / name).write_text(text)


def spec(tmp_path, file, **more):
    zones = {"raw": f"{tmp_path}/raw", "curated1": f"{tmp_path}/c1"}
    return lw.BatchSpec(
        zones=zones, container="acme", file=file, load_time=AT, instance_id=1, **more
    )


def merge(tmp_path, schema, file, **more):
    return spec(
        tmp_path,
        file,
        table=f"{schema}.t",
        table_root=f"{tmp_path}/warehouse/t",
        **{"merge": "newest", "keys": "id", "recency": "at", "batch_id": file, **more},
    )


def business(spark, table, *columns):
    return rows(spark.table(table).select(*columns))


@pytest.mark.parametrize("curated", [None, "parquet", "orc", "csv", "json"])
def test_merge_loads(spark, schema, tmp_path, curated):
    lake = {"curated_folder": "t", "curated_format": curated} if curated else {}
    lake |= {"history_root": f"{tmp_path}/history"}
    land(tmp_path, "1.csv", "id,at,v v\n1,10,a\n1,10,a\n2,10,b\n")
    land(tmp_path, "2.csv", "id,at,v v\n1,11,A\n2,9,late\n3,5,c\n")
    first = lw.ingest_batch(spark, merge(tmp_path, schema, "1.csv", **lake))
    second = lw.ingest_batch(spark, merge(tmp_path, schema, "2.csv", **lake))

    value = "vv" if curated in (None, "parquet") else "v v"
    assert business(spark, f"{schema}.t", "id", "at", value) == {
        (1, 11, "A"): 1,
        (2, 10, "b"): 1,
        (3, 5, "c"): 1,
    }
    assert (first.raw_count, first.source_count, first.transform_count) == (3, 2, 2)
    assert (second.raw_count, second.rows_out, second.operation) == (3, 3, "upsert newest")
    if curated:
        back = lw.read_path(spark, f"{tmp_path}/c1/acme/t", curated)
        assert back.count() == 3 and set(lw.AUDIT_COLUMNS[1:]) <= set(back.columns)
    history = lw.load_history(spark, f"{tmp_path}/history")
    assert rows(history.select("load_id", "raw_count", "rows_out")) == {
        ("1.csv", 3, 2): 1,
        ("2.csv", 3, 3): 1,
    }


def test_a_load_can_be_repeated_after_its_merge(spark, schema, tmp_path):
    land(tmp_path, "1.csv", "id,at,v\n1,10,a\n")
    load = merge(tmp_path, schema, "1.csv", curated_folder="t")
    assert lw.ingest_batch(spark, load).rows_out == 1
    assert lw.ingest_batch(spark, load).rows_out == 1
    assert business(spark, f"{schema}.t", "id", "v") == {(1, "a"): 1}


def test_soft_merge_loads_keep_history(spark, schema, tmp_path):
    land(tmp_path, "1.csv", "id,at,v\n1,10,a\n2,10,b\n")
    land(tmp_path, "2.csv", "id,at,v\n1,11,A\n2,9,late\n")
    for file in ("1.csv", "2.csv"):
        lw.ingest_batch(spark, merge(tmp_path, schema, file, merge="soft"))
    assert business(spark, f"{schema}.t", "id", "v", "ELT_ActiveFlag") == {
        (1, "a", 0): 1,
        (1, "A", 1): 1,
        (2, "b", 1): 1,
        (2, "late", 0): 1,
    }


def test_merge_without_recency_replaces_keys(spark, schema, tmp_path):
    land(tmp_path, "1.csv", "id,at,v\n1,10,a\n2,10,b\n")
    land(tmp_path, "2.csv", "id,at,v\n1,1,A\n1,2,B\n")
    for file in ("1.csv", "2.csv"):
        lw.ingest_batch(spark, merge(tmp_path, schema, file, recency=""))
    assert business(spark, f"{schema}.t", "id", "v") == {(1, "A"): 1, (1, "B"): 1, (2, "b"): 1}


def test_merge_loads_can_take_the_newest_row_per_key(spark, schema, tmp_path):
    land(tmp_path, "1.csv", "id,at,v\n1,10,a\n1,9,old\n")
    land(tmp_path, "2.csv", "id,at,v\n1,11,A\n1,12,B\n2,1,c\n")
    for file in ("1.csv", "2.csv"):
        lw.ingest_batch(spark, merge(tmp_path, schema, file, dedupe_batch=True))
    assert business(spark, f"{schema}.t", "id", "v") == {(1, "B"): 1, (2, "c"): 1}


@pytest.mark.parametrize("in_place", [True, False])
def test_partitioned_merge_loads(spark, schema, tmp_path, in_place):
    how = {"partition_by": "day", "keys_fix_partition": in_place}
    land(tmp_path, "1.csv", "id,at,day\n1,10,1\n2,10,2\n3,10,3\n")
    land(tmp_path, "2.csv", "id,at,day\n2,11,2\n4,5,2\n")
    lw.ingest_batch(spark, merge(tmp_path, schema, "1.csv", **how))
    result = lw.ingest_batch(spark, merge(tmp_path, schema, "2.csv", **how))
    assert business(spark, f"{schema}.t", "id", "at", "day") == {
        (1, 10, 1): 1,
        (2, 11, 2): 1,
        (3, 10, 3): 1,
        (4, 5, 2): 1,
    }
    assert result.rows_out == (2 if in_place else 4), "only the touched day is written"


def test_inserts_append_and_overwrite(spark, schema, tmp_path):
    land(tmp_path, "1.csv", "id,v\n1,a\n1,a\n")
    land(tmp_path, "2.csv", "v,id\nb,2\n")
    insert = lambda file, mode: lw.ingest_batch(
        spark, spec(tmp_path, file, table=f"{schema}.t", table_mode=mode)
    )
    assert insert("1.csv", "append").rows_out == 1
    assert insert("2.csv", "append").rows_out == 1
    assert business(spark, f"{schema}.t", "id", "v") == {(1, "a"): 1, (2, "b"): 1}
    assert insert("2.csv", "overwrite").operation == "insert overwrite"
    row = spark.table(f"{schema}.t").collect()[0].asDict()
    assert row["ELT_SourceFile"] == f"{tmp_path}/raw/acme/2.csv"
    assert row["ELT_TransformInstanceID"] == 1
    kinds = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE {schema}.t").collect()}
    assert kinds["v"] == "varchar(4000)"


def test_inserts_into_partitions(spark, schema, tmp_path):
    land(tmp_path, "1.csv", "day,v\n1,a\n2,b\n")
    for mode in ("append", "append", "overwrite"):
        lw.ingest_batch(
            spark,
            spec(tmp_path, "1.csv", table=f"{schema}.t", table_mode=mode, partition_by="day"),
        )
        found = business(spark, f"{schema}.t", "day", "v")
    assert found == {(1, "a"): 1, (2, "b"): 1}
    assert partition_columns(spark, f"{schema}.t") == ["day"]


def test_nested_json_load(spark, tmp_path):
    lines = [
        {"id": 1, "who": {"full name": "a"}, "n": [{"x": 1}, {"x": 2}]},
        {"id": 2, "who": None, "n": []},
    ]
    land(tmp_path, "e.json", "\n".join(json.dumps(line) for line in lines))
    result = lw.ingest_batch(
        spark, spec(tmp_path, "e.json", flatten=True, tenant="acme", curated_folder="e")
    )
    back = lw.read_path(spark, f"{tmp_path}/c1/acme/e", "parquet")
    assert rows(back.select("id", "who_fullname", "n_x", "company_code")) == {
        (1, "a", 1, "ACME"): 1,
        (1, "a", 2, "ACME"): 1,
        (2, None, None, "ACME"): 1,
    }
    assert (result.source_count, result.transform_count) == (2, 3)


def test_an_empty_batch_changes_nothing(spark, schema, tmp_path):
    how = {"curated_folder": "t", "history_root": f"{tmp_path}/history"}
    land(tmp_path, "1.csv", "id,at,v\n1,10,a\n")
    land(tmp_path, "2.csv", "id,at,v\n")
    lw.ingest_batch(spark, merge(tmp_path, schema, "1.csv", **how))
    result = lw.ingest_batch(spark, merge(tmp_path, schema, "2.csv", **how))
    assert (result.operation, result.transform_count, result.rows_out) == ("none", 0, None)
    assert spark.table(f"{schema}.t").count() == 1
    assert lw.read_path(spark, f"{tmp_path}/c1/acme/t", "parquet").count() == 1
    assert lw.load_history(spark, f"{tmp_path}/history").count() == 2


@pytest.mark.parametrize("file", ["bad.csv", "all_bad.csv"])
@pytest.mark.parametrize("on_reject", ["null", "quarantine", "error"])
@pytest.mark.parametrize("curated", [True, False])
def test_values_that_do_not_fit(spark, schema, tmp_path, on_reject, curated, file):
    land(tmp_path, "1.csv", "id,at,v\n1,10,5\n")
    land(tmp_path, "bad.csv", "id,at,v\n2,10,five\n3,10,6\n")
    land(tmp_path, "all_bad.csv", "id,at,v\n2,10,five\n")
    how = {"curated_folder": "t"} if curated else {}
    lw.ingest_batch(spark, merge(tmp_path, schema, "1.csv", **how))
    second = merge(
        tmp_path, schema, file, on_reject=on_reject, reject_path=f"{tmp_path}/rejects", **how
    )
    found = lambda: business(spark, f"{schema}.t", "id", "v")
    good = {(3, 6): 1} if file == "bad.csv" else {}
    if on_reject == "error":
        with pytest.raises(ValueError, match="do not fit"):
            lw.ingest_batch(spark, second)
        assert found() == {(1, 5): 1}
        return
    result = lw.ingest_batch(spark, second)
    assert result.reject_count == 1
    if on_reject == "null":
        assert found() == {(1, 5): 1, (2, None): 1, **good}
    else:
        assert found() == {(1, 5): 1, **good}
        (bad,) = spark.read.parquet(f"{tmp_path}/rejects").collect()
        assert bad["id"] == 2 and bad["rejected_values"][0]["value"] == "five"


@pytest.mark.parametrize(
    ("more", "message"),
    [
        ({"merge": "newest"}, "needs key columns"),
        ({"merge": "newest", "keys": "id"}, "table and a table_root"),
        ({"merge": "best", "keys": "id"}, "merge must be"),
        (
            {"merge": "newest", "keys": "id", "table": "t", "table_root": "r", "dedupe_batch": 1},
            "recency",
        ),
        ({"keys": "id", "table": "t"}, "no merge is chosen"),
        ({"on_reject": "drop"}, "on_reject must be"),
        ({"on_reject": "quarantine"}, "reject_path"),
    ],
)
def test_wrong_settings_are_refused(spark, tmp_path, more, message):
    with pytest.raises(ValueError, match=message):
        lw.ingest_batch(spark, spec(tmp_path, "x.csv", **more))


def test_result_as_a_frame(spark):
    result = lw.LoadResult("b", "none", 3, 2, 1)
    assert result.to_frame(spark).collect()[0].asDict() == {
        "batch_id": "b",
        "operation": "none",
        "raw_count": 3,
        "source_count": 2,
        "transform_count": 1,
        "reject_count": 0,
        "rows_out": None,
    }


@pytest.mark.parametrize("curated", [True, False])
def test_the_source_is_evaluated_once(spark, schema, tmp_path, monkeypatch, curated):
    """Rows that leave the reader are counted by a stage that cannot be skipped."""
    from lakeweir.plans import batch as module

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for item in batches:
            seen.add(item.num_rows)
            yield item

    read = module.read_dataset
    monkeypatch.setattr(
        module,
        "read_dataset",
        lambda *a, **k: (lambda df: df.mapInArrow(count, df.schema))(read(*a, **k)),
    )
    land(tmp_path, "1.csv", "id,at,v\n" + "".join(f"{i},1,x\n" for i in range(50)))
    how = {"curated_folder": "t"} if curated else {}
    lw.ingest_batch(spark, merge(tmp_path, schema, "1.csv", **how))
    lw.ingest_batch(spark, merge(tmp_path, schema, "1.csv", **how, batch_id="again"))
    # Each load looks for a first row, then reads all 50 once.
    assert 100 <= seen.value <= 200
    assert spark.table(f"{schema}.t").count() == 50
    assert spark.table(f"{schema}.t").where(F.col("at") == 1).count() == 50


def test_loads_of_two_tables_under_one_batch_id_keep_apart(spark, schema, tmp_path):
    before = staged_folders(spark)
    land(tmp_path, "1.csv", "id,v\n" + "".join(f"{i},{i}\n" for i in range(40)) + "x,bad\n")
    shared = {"target_schema": T.StructType.fromDDL("id int, v string"), "on_reject": "quarantine"}
    shared |= {"reject_path": f"{tmp_path}/rejects", "history_root": f"{tmp_path}/history", "batch_id": "day"}
    loads = [spec(tmp_path, "1.csv", table=f"{schema}.t{i}", **shared) for i in range(4)]
    with ThreadPoolExecutor(4) as pool:
        results = list(pool.map(lambda load: lw.ingest_batch(spark, load), loads))
    assert {(r.transform_count, r.reject_count) for r in results} == {(40, 1)}
    assert all(spark.table(f"{schema}.t{i}").count() == 40 for i in range(4))
    history = lw.load_history(spark, f"{tmp_path}/history")
    assert {r["target"] for r in history.collect()} == {f"{schema}.t{i}" for i in range(4)}
    assert spark.read.parquet(f"{tmp_path}/rejects").count() == 4
    assert staged_folders(spark) == before
