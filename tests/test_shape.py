"""De-duplication, names, alignment, flattening, audit columns, string bounds."""

import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

import lakeweir as lw
from lakeweir.functions.columns import column_list, truthy
from tests.helpers import count_in, final_plan, rows

# --- de-duplication ----------------------------------------------------------


def test_copies_collapse_and_nulls_compare_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (None, None)], "a int, b string")
    assert rows(lw.drop_duplicate_rows(df)) == {(1, None): 1, (1, "a"): 1, (None, None): 1}
    counted = lw.drop_duplicate_rows(df, copies="n")
    assert rows(counted) == {(1, None, 2): 1, (1, "a", 1): 1, (None, None, 1): 1}


def test_keys_limit_the_comparison(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "k int, v string")
    kept = lw.drop_duplicate_rows(df, "k").collect()
    assert sorted(r["k"] for r in kept) == [1, 2]
    counted = lw.drop_duplicate_rows(df, ["k"], copies="n")
    assert counted.columns == ["k", "v", "n"]
    assert sorted((r["k"], r["n"]) for r in counted.collect()) == [(1, 2), (2, 1)]


def test_maps_compare_by_content_at_any_depth(spark):
    schema = "id int, m map<string,int>, deep array<struct<m: map<string,array<int>>>>"
    data = [
        (1, {"a": 1, "b": 2}, [({"x": [1]},)]),
        (1, {"b": 2, "a": 1}, [({"x": [1]},)]),
        (1, {"b": 2, "a": 1}, [({"x": [2]},)]),
        (1, None, None),
        (1, None, None),
        (1, {}, []),
    ]
    df = spark.createDataFrame(data, schema)
    once = lw.drop_duplicate_rows(df)
    assert once.columns == df.columns
    assert once.count() == 4
    counted = lw.drop_duplicate_rows(df, copies="n")
    assert sorted(r["n"] for r in counted.collect()) == [1, 1, 2, 2]


def test_a_null_struct_is_not_a_struct_of_nulls(spark):
    df = spark.createDataFrame(
        [(None,), ((None,),), (None,)], "s struct<m: map<string,int>>"
    )
    assert lw.drop_duplicate_rows(df).count() == 2


def test_variants_compare_by_content(spark):
    df = spark.sql(
        """SELECT parse_json(j) AS v FROM VALUES ('{"a":1,"b":2}'), ('{"b":2, "a":1}'), ('[1]')
           AS t(j)"""
    )
    assert lw.drop_duplicate_rows(df).count() == 2


def test_copies_collapse_before_the_shuffle(spark):
    df = spark.range(0, 40_000, 1, 4).select((F.col("id") * 0).alias("same"))
    plan = final_plan(lw.drop_duplicate_rows(df))
    assert count_in(plan, "HashAggregate") == 2 and count_in(plan, "Exchange") == 1


def test_latest_per_key_breaks_ties_the_same_way_every_time(spark):
    data = [(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (2, None, "n"), (None, 1, "p"), (None, 1, "p")]
    df = spark.createDataFrame(data, "k int, moment int, tag string")
    expected = {(1, 5, "b"): 1, (2, None, "n"): 1, (None, 1, "p"): 2}
    assert rows(lw.latest_per_key(df, "k", "moment")) == expected
    assert rows(lw.latest_per_key(df.repartition(7), "k", "moment")) == expected


# --- names and arguments -----------------------------------------------------


def test_spaces_leave_column_names(spark):
    df = spark.createDataFrame([(1, 2)], "`a b c` int, `  d` int")
    assert lw.strip_column_spaces(df).columns == ["abc", "d"]


@pytest.mark.parametrize("names", [["a b", "ab"], ["A b", "aB"]])
def test_names_that_would_collide_are_refused(spark, names):
    with pytest.raises(ValueError, match="share a name"):
        lw.strip_column_spaces(spark.createDataFrame([(1, 2)], ["x", "y"]).toDF(*names))


@given(st.lists(st.text("abcXYZ_ .", min_size=1).filter(lambda s: s.strip()), max_size=5))
def test_column_lists_come_as_list_or_text(names):
    stripped = [n.strip() for n in names]
    assert column_list(names) == column_list("|".join(names)) == stripped


@pytest.mark.parametrize(
    ("flag", "expected"),
    [("1", True), ("TRUE", True), ("true", True), (True, True), ("0", False), ("", False)],
)
def test_flags(flag, expected):
    assert truthy(flag) is expected


# --- alignment ---------------------------------------------------------------

TARGET = T.StructType(
    [
        T.StructField("Name", T.VarcharType(10)),
        T.StructField("id", T.LongType()),
        T.StructField("price", T.DecimalType(10, 2)),
        T.StructField("note", T.StringType()),
    ]
)


def test_alignment_orders_widens_and_fills(spark):
    df = spark.createDataFrame([(1, "a", 2.5, "x")], "ID int, name string, price double, extra string")
    aligned, rejects = lw.align_schema(df, TARGET)
    assert aligned.columns == ["Name", "id", "price", "note"]
    assert [f.dataType.simpleString() for f in aligned.schema.fields] == [
        "string",
        "bigint",
        "decimal(10,2)",
        "string",
    ]
    assert [str(v) for v in aligned.collect()[0]] == ["a", "1", "2.50", "None"]
    assert rejects.count() == 0


def test_fields_align_by_name_and_misfits_inside_are_reported(spark):
    df = spark.sql(
        "SELECT named_struct('a', 1, 'b', 2) s, array('1', 'x') l, map('k', '7') m, 2.7D d, "
        "timestamp'2024-01-02 03:04:05' t UNION ALL "
        "SELECT named_struct('a', 3, 'b', 4), array('5', null), map('k', 'y'), 2.0D, "
        "timestamp'2024-01-02 00:00:00'"
    )
    target = T.StructType.fromDDL(
        "s struct<b:int,a:int,c:string>, l array<int>, m map<string,int>, d bigint, t date"
    )
    got = lw.align_schema(df, target)[1].orderBy(F.col("s.a").desc()).collect()
    assert [r["s"].asDict() for r in got] == [
        {"b": 4, "a": 3, "c": None},
        {"b": 2, "a": 1, "c": None},
    ]
    assert [{v["column"] for v in r["rejected_values"]} for r in got] == [{"m"}, {"l", "d", "t"}]
    assert lw.align_schema(df.select("d", "t"), target, truncate=True)[0].count() == 2


def test_every_row_is_accepted_or_rejected_with_the_reason(spark):
    df = spark.createDataFrame(
        [("a", "1", "2"), ("b", "one", "2"), ("c", "x", "y"), ("d", None, "")],
        "name string, id string, price string",
    )
    aligned, rejects = lw.align_schema(df, TARGET)
    assert {r["Name"] for r in aligned.collect()} == {"a"}
    reasons = {
        r["Name"]: [(v["column"], v["value"]) for v in r["rejected_values"]]
        for r in rejects.collect()
    }
    assert reasons == {
        "b": [("id", "one")],
        "c": [("id", "x"), ("price", "y")],
        "d": [("price", "")],
    }


def test_strict_alignment_refuses_to_parse_text(spark):
    df = spark.createDataFrame([("1", "a")], "id string, name string")
    with pytest.raises(Exception, match="(?i)cast|type"):
        lw.align_schema(df, TARGET, cast="store")[0].collect()
    widened, _ = lw.align_schema(df.withColumn("id", F.lit(1)), TARGET, cast="store")
    assert widened.schema["id"].dataType == T.LongType()


def test_extra_and_missing_columns(spark):
    df = spark.createDataFrame([(1, 2)], "id int, other int")
    with pytest.raises(ValueError, match="not in the target"):
        lw.align_schema(df, TARGET, on_extra="error")
    required = T.StructType([T.StructField("needed", T.StringType(), False)])
    with pytest.raises(ValueError, match="requires columns"):
        lw.align_schema(df, required)


# --- flattening --------------------------------------------------------------


def nested(spark):
    return spark.createDataFrame(
        [
            (1, (("x", 2), [(10, ["p", "q"]), (11, [])])),
            (2, ((None, None), None)),
            (3, None),
        ],
        "id int, a struct<b: struct<c: string, d: int>, e: array<struct<f: int, g: array<string>>>>",
    )


def test_structs_become_columns_and_arrays_become_rows(spark):
    flat = lw.flatten(nested(spark))
    assert flat.columns == ["id", "a_b_c", "a_b_d", "a_e_f", "a_e_g"]
    assert rows(flat) == {
        (1, "x", 2, 10, "p"): 1,
        (1, "x", 2, 10, "q"): 1,
        (1, "x", 2, 11, None): 1,
        (2, None, None, None, None): 1,
        (3, None, None, None, None): 1,
    }


def test_flattening_can_stop_early(spark):
    assert lw.flatten(nested(spark), explode=False).columns == ["id", "a_b_c", "a_b_d", "a_e"]
    assert lw.flatten(nested(spark), max_depth=1).columns == ["id", "a_b", "a_e"]
    assert lw.flatten(nested(spark), sep=".", explode=False).columns[1] == "a.b.c"


def test_sibling_arrays_need_a_choice(spark):
    df = spark.createDataFrame([(1, [1, 2], [3, 4])], "id int, x array<int>, y array<int>")
    with pytest.raises(ValueError, match="siblings"):
        lw.flatten(df)
    assert rows(lw.flatten(df.drop("y"))) == {(1, 1): 1, (1, 2): 1}
    assert lw.flatten(df, explode_columns="x").count() == 2
    assert lw.flatten(df, explode_columns=["x", "y"]).count() == 4


def test_maps_stay_unless_listed(spark):
    df = spark.createDataFrame([(1, {"a": 2}), (2, None)], "id int, m map<string,int>")
    assert lw.flatten(df).columns == ["id", "m"]
    opened = lw.flatten(df, explode_columns="m")
    assert opened.columns == ["id", "m_key", "m_value"]
    assert rows(opened) == {(1, "a", 2): 1, (2, None, None): 1}


def test_clashing_flat_names_are_refused(spark):
    df = spark.createDataFrame([((1,), 2)], "a struct<b: int>, a_b int")
    with pytest.raises(ValueError, match="share a name"):
        lw.flatten(df)


def test_json_text_is_parsed_first(spark):
    df = spark.createDataFrame([('{"k": {"n": 1}}',), ("broken",)], "j string")
    flat = lw.flatten(lw.parse_json_column(df, "j", "k struct<n: int>"))
    assert flat.columns == ["j_k_n"] and rows(flat) == {(1,): 1, (None,): 1}


# --- audit columns -----------------------------------------------------------


def test_audit_columns(spark):
    at = dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc)
    df = lw.add_audit(spark.range(1), "12", "raw/x/y.csv", at, tenant="acme")
    assert df.columns == ["id", *lw.AUDIT_COLUMNS]
    assert [f.dataType.simpleString() for f in df.schema.fields[1:]] == [
        "string",
        "int",
        "string",
        "timestamp",
    ]
    row = df.withColumn("ELT_Timestamp", F.col("ELT_Timestamp").cast("string")).collect()[0]
    assert tuple(row) == (0, "ACME", 12, "raw/x/y.csv", "2024-01-02 03:04:05")


@pytest.mark.parametrize("instance", ["", None, "twelve"])
def test_an_unusable_instance_id_is_null(spark, instance):
    row = lw.add_audit(spark.range(1), instance, "p").collect()[0]
    assert row["ELT_TransformInstanceID"] is None
    assert row["ELT_Timestamp"].microsecond == 0


def test_audit_can_name_the_file_of_each_row(spark, tmp_path):
    spark.range(4).repartition(2).write.parquet(f"{tmp_path}/d")
    df = lw.add_audit(spark.read.parquet(f"{tmp_path}/d"), 1, "asked", per_file=True)
    files = {r["ELT_SourceFile"] for r in df.collect()}
    assert len(files) == 2 and all(f.endswith(".parquet") for f in files)


# --- string bounds -----------------------------------------------------------


def test_string_bounds(spark):
    df = spark.createDataFrame(
        [("é" * 4000, "a"), ("x" * 4001, None), (None, "b")], "long string, short string"
    )
    assert rows(lw.string_bound_report(df)) == {("long", 1, 4001): 1, ("short", 0, 1): 1}
    assert [len(r["long"]) for r in lw.overlong_rows(df).collect()] == [4001]
    assert lw.overlong_rows(df, 5000).count() == 0


def test_preview(spark):
    assert lw.preview(spark.range(9)).count() == 1
    assert lw.preview(spark.range(9), 3).count() == 3
