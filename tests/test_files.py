"""Zones, formats, readers and writers."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import lakeweir as lw
from lakeweir.sources.zones import PLAIN
from tests.helpers import count_in, final_plan, rows


@pytest.fixture
def zones(tmp_path):
    return {zone: f"{tmp_path}/{zone}" for zone in ("raw", "curated1", "curated2")}


def sample(spark):
    return spark.createDataFrame(
        [(1, "a", 1.5), (2, "b", None), (3, None, 2.5), (3, None, 2.5)],
        "id int, name string, price double",
    )


DISTINCT = {(1, "a", 1.5): 1, (2, "b", None): 1, (3, None, 2.5): 1}


# --- zones and formats -------------------------------------------------------


def test_paths():
    zones = {"raw": "/lake/raw/", "cloud": "abfss://{container}@account.example/"}
    assert lw.dataset_path(zones, "raw", "c", "f", "x.csv") == "/lake/raw/c/f/x.csv"
    assert lw.dataset_path(zones, "raw", "c", "/f/g/") == "/lake/raw/c/f/g"
    assert lw.dataset_path(zones, "raw", "c", None, "x.csv") == "/lake/raw/c/x.csv"
    assert lw.dataset_path(zones, "cloud", "c", "f") == "abfss://c@account.example/f"


@pytest.mark.parametrize(("folder", "file"), [(None, None), ("", "")])
def test_a_dataset_needs_a_folder_or_a_file(folder, file):
    with pytest.raises(ValueError, match="folder, a file"):
        lw.dataset_path({"raw": "/r"}, "raw", "c", folder, file)


def test_unknown_zones_are_named():
    with pytest.raises(ValueError, match="unknown zone"):
        lw.dataset_path({"raw": "/r"}, "cured", "c", "f")


@pytest.mark.parametrize(
    ("path", "fmt", "expected"),
    [
        ("/r/c/x.csv", None, "csv"),
        ("/r/c/x.TXT", None, "csv"),
        ("/r/c/x.csv.gz", None, "csv"),
        ("/r/c/x.parquet", None, "parquet"),
        ("/r/c/x.orc/", None, "orc"),
        ("/r/c/x.json", None, "json"),
        ("/r/c.csv.d/x.json", None, "json"),
        ("/r/c/x", None, PLAIN),
        ("/r/c/x.dat", "", PLAIN),
        ("/r/c/x.csv", "orc", "orc"),
        ("/r/c/x", "TXT", "csv"),
    ],
)
def test_formats(path, fmt, expected):
    assert lw.choose_format(path, fmt) == expected


# --- round trips -------------------------------------------------------------


@pytest.mark.parametrize("zone", ["raw", "curated1", "curated2"])
@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_round_trips_drop_duplicate_rows(spark, zones, zone, fmt):
    df = sample(spark)
    if fmt == "csv":
        df = df.na.drop()
    if fmt == "json" and zone != "raw":
        df = df.limit(1).coalesce(1)  # outside raw, a JSON file is one document
    lw.write_dataset(df, zones, zone, "c", "f", f"x.{fmt}", fmt=fmt)
    back = lw.read_dataset(spark, zones, zone, "c", "f", f"x.{fmt}").select(*df.columns)
    assert rows(back) == rows(df.distinct())


def test_json_documents_over_several_lines(spark, zones, tmp_path):
    place = tmp_path / "curated1" / "c"
    place.mkdir(parents=True)
    (place / "x.json").write_text('[\n {"a": 1,\n  "b": "x"},\n {"a": 2, "b": null}\n]\n')
    whole = lw.read_dataset(spark, zones, "curated1", "c", None, "x.json")
    assert rows(whole) == {(1, "x"): 1, (2, None): 1}
    by_line = lw.read_dataset(spark, zones, "curated1", "c", None, "x.json", multiline=False)
    assert "_corrupt_record" in by_line.columns


def test_raw_csv_records_span_lines(spark, zones, tmp_path):
    place = tmp_path / "raw" / "c"
    place.mkdir(parents=True)
    (place / "x.csv").write_text('id;name of it\n1;"two\nlines"\n1;"two\nlines"\n2;x\n')
    df = lw.read_dataset(spark, zones, "raw", "c", None, "x.csv", sep=";")
    assert df.columns == ["id", "name of it"]
    assert rows(df) == {(1, "two\nlines"): 1, (2, "x"): 1}


def test_a_blank_separator_means_the_default(spark, zones, tmp_path):
    place = tmp_path / "raw" / "c"
    place.mkdir(parents=True)
    (place / "x.txt").write_text("1,a\n2,b\n")
    df = lw.read_dataset(spark, zones, "raw", "c", "", "x.txt", sep="", header=False)
    assert rows(df) == {(1, "a"): 1, (2, "b"): 1}


def test_unknown_extensions_are_plain_text_columns(spark, zones, tmp_path):
    place = tmp_path / "raw" / "c"
    place.mkdir(parents=True)
    (place / "x.dat").write_text("id,name\n1,a\n")
    df = lw.read_dataset(spark, zones, "raw", "c", None, "x.dat")
    assert df.columns == ["_c0", "_c1"]
    assert rows(df) == {("id", "name"): 1, ("1", "a"): 1}


def test_csv_writes_null_as_zero_and_timestamps_in_seconds(spark, zones, tmp_path):
    df = spark.sql(
        """SELECT CAST(NULL AS INT) AS a, CAST(NULL AS STRING) AS b, '' AS c,
           TIMESTAMP_NTZ '2024-01-02 03:04:05.678' AS d, TIMESTAMP '2024-01-02 03:04:05.678' AS e"""
    )
    lw.write_dataset(df, zones, "curated1", "c", "f", fmt="csv")
    (part,) = glob.glob(f"{tmp_path}/curated1/c/f/part-*")
    assert open(part).read() == (
        'a,b,c,d,e\n0,0,"",2024-01-02 03:04:05,2024-01-02 03:04:05\n'
    )
    lw.write_dataset(df, zones, "curated1", "c", "g", fmt="txt", sep="|", null_value="NA")
    (part,) = glob.glob(f"{tmp_path}/curated1/c/g/part-*")
    assert open(part).readlines()[1].startswith("NA|NA|")


def test_duplicates_can_stay(spark, zones):
    lw.write_dataset(sample(spark), zones, "raw", "c", "f")
    read = lambda **how: lw.read_dataset(spark, zones, "raw", "c", "f", fmt="parquet", **how)
    assert read(dedupe=False).count() == 4
    assert rows(read()) == DISTINCT
    assert read(dedupe_keys="price").count() == 3
    plan = final_plan(read(dedupe=False).select("id"))
    assert "ReadSchema: struct<id:int>" in plan and "Exchange" not in plan


def test_missing_delta_is_refused(spark, zones):
    with pytest.raises(ValueError, match="no Delta support"):
        lw.write_dataset(sample(spark), zones, "curated1", "c", "f", fmt="delta")
    with pytest.raises(ValueError, match="no Delta support"):
        lw.read_dataset(spark, zones, "curated1", "c", "f", fmt="delta")


def test_files_with_columns_in_another_order_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,qty\n1,2\n")
    (tmp_path / "b.csv").write_text("qty,id\n20,10\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        lw.read_path(spark, str(tmp_path), "csv").collect()


def test_other_formats_go_by_name(spark, zones):
    df = spark.createDataFrame([("a",), ("b",)], "value string")
    lw.write_dataset(df, zones, "curated2", "c", "f", fmt="text")
    assert rows(lw.read_dataset(spark, zones, "curated2", "c", "f", fmt="text")) == rows(df)


# --- modes -------------------------------------------------------------------


def test_save_modes(spark, zones):
    one, two = spark.range(1), spark.range(2)
    write = lambda df, mode: lw.write_dataset(df, zones, "curated1", "c", "f", mode=mode)
    count = lambda: lw.read_dataset(
        spark, zones, "curated1", "c", "f", fmt="parquet", dedupe=False
    ).count()
    write(one, "error")
    write(two, "ignore")
    assert count() == 1
    write(two, "append")
    assert count() == 3
    write(two, "overwrite")
    assert count() == 2
    for mode in ("error", "errorifexists"):
        with pytest.raises(Exception, match="already exists"):
            write(one, mode)
    with pytest.raises(ValueError, match="write mode"):
        write(one, "upsert")


# --- layouts -----------------------------------------------------------------


def test_partitions_are_pruned_and_gathered(spark, tmp_path):
    df = spark.range(0, 1000, 1, 8).select("id", (F.col("id") % 5).cast("int").alias("day"))
    path = f"{tmp_path}/parts"
    lw.write_path(df, path, partition_by="day")
    assert len(glob.glob(f"{path}/day=*/*.parquet")) == 5
    back = lw.read_path(spark, path, "parquet", schema=df.schema).where("day = 3")
    plan = final_plan(back)
    assert "PartitionFilters: [isnotnull(day" in plan and "(day#" in plan
    assert back.count() == 200


def test_text_partitions_keep_their_zeros(spark, tmp_path):
    df = spark.createDataFrame([(1, "01")], "id int, month string")
    lw.write_path(df, f"{tmp_path}/m", partition_by=["month"])
    back = lw.read_path(spark, f"{tmp_path}/m", "parquet", schema=df.schema)
    assert rows(back) == {(1, "01"): 1}


def test_a_large_partition_is_split(spark, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50KB")
    hot = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    df = spark.range(0, 60_000, 1, 8).select(hot.alias("k"), "id")
    plan = final_plan(lw.hash_layout(df, "k"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and "skewed" in plan
    assert "REBALANCE_PARTITIONS_BY_NONE" in final_plan(lw.even_layout(df))


def test_ranges_are_narrow_and_hot_values_span_files(spark, tmp_path):
    value = F.when(F.col("id") % 3 == 0, F.lit(500)).otherwise(F.col("id") % 1000)
    df = spark.range(0, 30_000, 1, 8).select(value.alias("v"), F.lit("same").alias("t"))
    path = f"{tmp_path}/r"
    lw.write_path(lw.range_layout(df, "v", partitions=9), path)
    ranges = []
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.read_metadata(file)
        stats = [meta.row_group(i).column(0).statistics for i in range(meta.num_row_groups)]
        ranges.append((min(s.min for s in stats), max(s.max for s in stats), meta.num_rows))
    ranges.sort()
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    assert max(r[2] for r in ranges) < 0.25 * 30_000, "the hot value is in several files"
    back = lw.read_path(spark, path, "parquet")
    assert rows(back) == rows(df)
    plan = final_plan(back.where("v BETWEEN 100 AND 120"))
    assert "GreaterThanOrEqual(v,100)" in plan and count_in(plan, "PushedFilters") == 1


def test_trees_are_read_from_their_root(spark, tmp_path):
    for month, day in ((1, 2), (1, 3), (2, 1)):
        spark.createDataFrame([(month, day)], "m int, d int").write.csv(
            f"{tmp_path}/processA/{month}/{day}/00", header=True
        )
    root = f"{tmp_path}/processA"
    found = lw.read_path(spark, root, "csv", recursive=True)
    assert rows(found) == {(1, 2): 1, (1, 3): 1, (2, 1): 1}


def test_schema_may_be_given_as_text_or_type(spark, tmp_path):
    sample(spark).write.csv(f"{tmp_path}/x.csv", header=True)
    typed = T.StructType.fromDDL("id string, name string, price string")
    for schema in (typed, "id string, name string, price string"):
        df = lw.read_path(spark, f"{tmp_path}/x.csv", schema=schema)
        assert df.schema == typed
