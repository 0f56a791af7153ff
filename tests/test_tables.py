"""Warehouse tables."""

import glob

import pytest
from pyspark.sql import functions as F

import lakeweir as lw
from lakeweir.sources import tables
from tests.helpers import final_plan, rows, staged_folders


def people(spark, *items):
    return spark.createDataFrame(list(items), "id int, name string")


def test_reading_tables_views_and_queries(spark, schema):
    lw.save_table(people(spark, (1, "a"), (2, "b")), f"{schema}.p")
    spark.sql(f"CREATE VIEW {schema}.v AS SELECT id FROM {schema}.p WHERE id > 1")
    assert rows(lw.read_table(spark, f"{schema}.p")) == {(1, "a"): 1, (2, "b"): 1}
    assert rows(lw.read_table(spark, f"{schema}.v")) == {(2,): 1}
    assert rows(lw.read_query(spark, f"SELECT count(*) FROM {schema}.p")) == {(2,): 1}


def test_jdbc_needs_one_thing_to_read(spark):
    for what in ({}, {"table": "t", "query": "q"}):
        with pytest.raises(ValueError, match="either a table or a query"):
            lw.read_jdbc(spark, "jdbc:x", **what)


# --- inserts -----------------------------------------------------------------


def test_created_tables_bound_their_strings(spark, schema):
    name = f"{schema}.p"
    lw.insert_table(people(spark, (1, "x" * 4000)), name, "append")
    kinds = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE {name}").collect()}
    assert kinds == {"id": "int", "name": "varchar(4000)"}
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        lw.insert_table(people(spark, (2, "x" * 4001)), name, "append")
    assert spark.table(name).count() == 1


def test_insert_modes(spark, schema):
    name = f"{schema}.p"
    lw.insert_table(people(spark, (1, "a")), name, "error")
    lw.insert_table(people(spark, (2, "b")), name, "ignore")
    assert rows(spark.table(name)) == {(1, "a"): 1}
    lw.insert_table(people(spark, (2, "b")).select("name", "id"), name, "append")
    assert rows(spark.table(name)) == {(1, "a"): 1, (2, "b"): 1}
    lw.insert_table(people(spark, (3, "c")), name, "overwrite")
    assert rows(spark.table(name)) == {(3, "c"): 1}
    for mode in ("error", "errorifexists"):
        with pytest.raises(ValueError, match="already exists"):
            lw.insert_table(people(spark, (4, "d")), name, mode)
    for mode in ("merge", None):
        with pytest.raises(ValueError, match="write mode"):
            lw.insert_table(people(spark, (4, "d")), name, mode)


def test_overwrite_keeps_declared_types(spark, schema):
    name = f"{schema}.p"
    spark.sql(f"CREATE TABLE {name} (id BIGINT, name VARCHAR(5)) USING parquet")
    lw.insert_table(people(spark, (1, "abcde")), name, "overwrite")
    kinds = [r["data_type"] for r in spark.sql(f"DESCRIBE {name}").collect()]
    assert kinds == ["bigint", "varchar(5)"]
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        lw.insert_table(people(spark, (1, "abcdef")), name, "overwrite")


def test_overwrite_replaces_all_partitions(spark, schema, conf):
    conf("spark.sql.sources.partitionOverwriteMode", "dynamic")
    name = f"{schema}.p"
    spark.sql(f"CREATE TABLE {name} (name STRING, id INT) USING parquet PARTITIONED BY (id)")
    lw.insert_table(people(spark, (1, "a"), (2, "b")), name, "overwrite")
    lw.insert_table(people(spark, (2, "c")), name, "overwrite")
    assert rows(spark.table(name)) == {("c", 2): 1}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "dynamic"


def test_unknown_columns_are_refused(spark, schema):
    name = f"{schema}.p"
    lw.insert_table(people(spark, (1, "a")), name, "append")
    with pytest.raises(ValueError, match="not in the target"):
        lw.insert_table(people(spark, (1, "a")).withColumn("x", F.lit(1)), name, "append")


def test_hooks_before_and_after(spark, schema):
    name = f"{schema}.p"
    lw.insert_table(people(spark, (1, "a")), name, "append")
    lw.insert_table(
        people(spark, (2, "b"), (3, "c")),
        name,
        "append",
        pre_sql=[f"TRUNCATE TABLE {name}", f"INSERT INTO {name} VALUES (9, 'z')"],
        post_sql=f"INSERT INTO {name} SELECT id + 10, name FROM STG_p WHERE id > 2",
    )
    assert rows(spark.table(name)) == {(9, "z"): 1, (13, "c"): 1}
    assert not spark.catalog.tableExists("STG_p")


def test_a_statement_before_the_load_may_drop_the_table(spark, schema):
    name = f"{schema}.p"
    lw.insert_table(people(spark, (1, "a")), name, "append")
    lw.insert_table(people(spark, (2, "b")), name, "append", pre_sql=f"DROP TABLE {name}")
    assert rows(spark.table(name)) == {(2, "b"): 1}


def test_the_staging_prefix_goes_to_the_table_part():
    assert tables.staging_view_name("sales.orders") == "STG_orders"
    assert tables.staging_view_name("orders") == "STG_orders"


def test_staging_evaluates_the_batch_once(spark, schema):
    name = f"{schema}.p"
    lw.insert_table(people(spark, (1, "a")), name, "append")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    batch = people(spark, (2, "b")).mapInArrow(count, "id int, name string")
    post = f"INSERT INTO {name} SELECT id, name FROM STG_p"
    lw.insert_table(batch, name, "append", post_sql=[post, post])
    assert spark.table(name).count() == 3 and seen.value == 1


# --- working tables ----------------------------------------------------------


def test_working_tables_are_spread_evenly_or_by_key(spark, schema):
    df = spark.range(0, 1000, 1, 8).select((F.col("id") % 10).alias("k"), "id")
    for how in ({}, {"partitions": 3}, {"hash_column": "k"}, {"hash_column": "k", "buckets": 4}):
        lw.write_temp_table(df, f"{schema}.w", **how)
        assert rows(spark.table(f"{schema}.w")) == rows(df)
    plan = final_plan(spark.table(f"{schema}.w").groupBy("k").count())
    assert "Exchange" not in plan, "the recorded buckets serve the aggregate"
    with pytest.raises(ValueError, match="hash column"):
        lw.write_temp_table(df, f"{schema}.w", buckets=4)


# --- publishing --------------------------------------------------------------


def test_publish_moves_a_table_that_the_result_was_read_from(spark, schema, tmp_path):
    name, root = f"{schema}.p", f"{tmp_path}/versions"
    assert lw.publish(people(spark, (1, "a"), (2, "b")), name, root, "one") == 2
    merged = lw.replace_keys(spark.table(name), people(spark, (2, "c")), "id")
    assert lw.publish(merged, name, root, "two") == 2
    assert rows(spark.table(name)) == {(1, "a"): 1, (2, "c"): 1}
    assert rows(spark.read.parquet(f"{root}/v=one")) == {(1, "a"): 1, (2, "b"): 1}
    with pytest.raises(ValueError, match="current version"):
        lw.publish(spark.table(name), name, root, "two")


def test_replaced_versions_can_be_retired(spark, schema, tmp_path):
    name, root = f"{schema}.p", f"{tmp_path}/it's/v"
    lw.publish(people(spark, (1, "a")), name, root, "one", partition_by="id")
    lw.publish(people(spark, (2, "b")), name, root, "two", partition_by="id")
    lw.retire_version(spark, name, root, "one")
    assert not glob.glob(f"{root}/v=one/id=*")
    assert rows(spark.table(name)) == {("b", 2): 1}
    with pytest.raises(ValueError, match="current version"):
        lw.retire_version(spark, name, root, "two")


def test_publish_refuses_overlong_strings(spark, schema, tmp_path):
    name = f"{schema}.p"
    lw.publish(people(spark, (1, "a")), name, f"{tmp_path}/v", "one")
    with pytest.raises(ValueError, match="more than 4000"):
        lw.publish(people(spark, (1, "é" * 4001)), name, f"{tmp_path}/v", "two")
    assert rows(spark.table(name)) == {(1, "a"): 1}


def test_publish_partitioned(spark, schema, tmp_path):
    name, root = f"{schema}.p", f"{tmp_path}/v"
    lw.publish(people(spark, (1, "a"), (2, "b")), name, root, "one", partition_by="id")
    lw.publish(people(spark, (2, "c"), (3, "d")), name, root, "two", partition_by="id")
    assert rows(spark.table(name)) == {("c", 2): 1, ("d", 3): 1}
    assert tables.partition_columns(spark, name) == ["id"]


def test_only_touched_partitions_are_rewritten(spark, schema, tmp_path):
    name, root = f"{schema}.p", f"{tmp_path}/v"
    columns = "id int, name string, day int"
    start = [(1, "a", 1), (2, "b", 2), (3, "c", None), (4, "d", 4)]
    lw.publish(spark.createDataFrame(start, columns), name, root, "one", partition_by="day")
    before = {f for f in glob.glob(f"{root}/v=one/*/*.parquet")}
    batch = spark.createDataFrame([(2, "B", 2), (5, "e", 2), (3, "C", None)], columns)

    touched = lw.touched_partitions(spark.table(name), batch, "day")
    assert rows(touched) == {(2, "b", 2): 1, (3, "c", None): 1}
    assert lw.replace_partitions(lw.replace_keys(touched, batch, "id"), name) == 3
    assert rows(spark.table(name)) == {
        (1, "a", 1): 1,
        (2, "B", 2): 1,
        (3, "C", None): 1,
        (4, "d", 4): 1,
        (5, "e", 2): 1,
    }
    kept = before & set(glob.glob(f"{root}/v=one/*/*.parquet"))
    assert {f.split("/day=")[1].split("/")[0] for f in kept} == {"1", "4"}


def test_touched_partitions_prune_the_scan(spark, schema, tmp_path):
    name = f"{schema}.p"
    df = spark.range(100).select("id", (F.col("id") % 10).cast("int").alias("day"))
    lw.publish(df, name, f"{tmp_path}/v", "one", partition_by="day")
    touched = lw.touched_partitions(spark.table(name), df.where("day IN (3, 4)"), ["day"])
    plan = final_plan(touched)
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert ">= 3" in filters and "<= 4" in filters


def test_partitions_are_pruned_the_same_way_at_any_number(spark, schema, tmp_path):
    name = f"{schema}.p"
    days = (F.col("id") % 7).cast("int").alias("day"), (F.col("id") % 3).cast("string").alias("part")
    df = spark.range(60).select("id", *days)
    lw.publish(df, name, f"{tmp_path}/v", "one", partition_by="day|part")
    batch = df.where("id IN (8, 9, 16)")
    wanted = {(r["day"], r["part"]) for r in batch.collect()}
    touched = lw.touched_partitions(spark.table(name), batch, ["day", "part"])
    expected = [r["id"] for r in df.collect() if (r["day"], r["part"]) in wanted]
    assert sorted(r["id"] for r in touched.collect()) == sorted(expected)
    assert lw.touched_partitions(spark.table(name), batch.limit(0), ["day"]).collect() == []


def test_a_version_inside_a_managed_table_is_refused(spark, schema):
    name = f"{schema}.m"
    lw.insert_table(people(spark, (1, "a")), name, "append")
    with pytest.raises(ValueError, match="managed table"):
        lw.publish(people(spark, (2, "b")), name, tables.table_location(spark, name), "two")
    assert rows(spark.table(name)) == {(1, "a"): 1}


def test_the_same_batch_is_inserted_once(spark, schema):
    name = f"{schema}.t"
    for batch in ("one", "one", "two"):
        assert lw.insert_table(people(spark, (1, "a")), name, "append", batch_id=batch)
    assert rows(spark.table(name)) == {(1, "a"): 2}
    assert not lw.insert_table(people(spark, (1, "a")), name, "ignore", batch_id="three")
    # An earlier batch is remembered as well as the last one.
    assert lw.insert_table(people(spark, (1, "a")), name, "append", batch_id="one")
    assert rows(spark.table(name)) == {(1, "a"): 2}


def test_a_load_that_ends_in_sql_runs_once_and_frees_its_copy(spark, schema):
    name, before = f"{schema}.p", staged_folders(spark)
    lw.insert_table(people(spark), name, "append")
    for batch in ("one", "one", "two", "one"):
        sql = f"INSERT INTO {name} SELECT * FROM STG_p"
        assert lw.insert_table(people(spark, (1, "a")), name, "append", post_sql=sql, batch_id=batch)
    assert rows(spark.table(name)) == {(1, "a"): 2}
    with pytest.raises(Exception, match="no_such_table"):
        lw.insert_table(people(spark, (1, "a")), name, "append", post_sql="INSERT INTO no_such_table SELECT * FROM STG_p", batch_id="three")
    assert staged_folders(spark) == before


@pytest.mark.parametrize("partition_by", [None, "name"])
def test_any_batch_replaces_itself(spark, schema, partition_by):
    name = f"{schema}.b"
    assert lw.insert_batch(people(spark, (1, "a"), (2, "b/%"), (5, None)), name, "it's one", partition_by) == 3
    assert lw.insert_batch(people(spark, (3, "a")), name, "two", partition_by) == 1
    # Again with other rows, of which none is in the partition of b any more.
    assert lw.insert_batch(people(spark, (1, "A"), (9, "a")), name, "it's one", partition_by) == 2
    assert rows(spark.table(name).select("id", "name")) == {(1, "A"): 1, (9, "a"): 1, (3, "a"): 1}
    assert lw.insert_batch(people(spark), name, "it's one", partition_by) == 0
    assert rows(spark.table(name).select("id", "name", "ELT_BatchID")) == {(3, "a", "two"): 1}
    with pytest.raises(ValueError, match="column"):
        lw.insert_batch(spark.table(name), name, "three")
    lw.insert_table(people(spark, (1, "a")), f"{schema}.plain", "append")
    with pytest.raises(ValueError, match="partitioned"):
        lw.insert_batch(people(spark, (1, "a")), f"{schema}.plain", "one")


def test_a_merged_table_remembers_all_batches(spark, schema, tmp_path):
    name = f"{schema}.m"
    for batch in ("one", "two", "three"):
        lw.publish(people(spark, (1, batch)), name, f"{tmp_path}/m", batch)
    assert tables.batches_of(spark, name) == {"one", "two", "three"}
    for batch in ("one", "two"):
        lw.publish(people(spark, (1, batch)), f"{name}p", f"{tmp_path}/mp", batch, partition_by="name")
    assert tables.batches_of(spark, f"{name}p") == {"one", "two"}


# --- lifecycle ---------------------------------------------------------------


def test_external_data_survives_drops(spark, tmp_path):
    name = f"life_{tmp_path.name[-8:].replace('-', '_')}"
    df = people(spark, (1, "a"))
    lw.write_path(df, f"{tmp_path}/d", fmt="parquet")
    lw.create_schema(spark, name)
    for _ in range(2):
        lw.register_table(spark, f"{name}.p", f"{tmp_path}/d", df.schema)
    assert rows(spark.table(f"{name}.p")) == {(1, "a"): 1}
    lw.drop_table(spark, f"{name}.p")
    lw.register_table(spark, f"{name}.p", f"{tmp_path}/d", df.schema)
    lw.drop_schema(spark, name)
    assert not spark.catalog.databaseExists(name)
    assert spark.read.parquet(f"{tmp_path}/d").count() == 1


def test_history_has_one_row_per_load(spark, tmp_path):
    root = f"{tmp_path}/history"
    assert lw.load_history(spark, root).count() == 0
    lw.record_load(spark, root, "001", "insert", "t", rows_out=1)
    lw.record_load(spark, root, "001", "insert", "t", rows_out=2)
    lw.record_load(spark, root, "002", "upsert", "t", raw_count=5)
    history = lw.load_history(spark, root).select("load_id", "operation", "raw_count", "rows_out")
    assert rows(history) == {("001", "insert", None, 2): 1, ("002", "upsert", 5, None): 1}
    # Another target under the same id has a row of its own; rows of the former layout are read too.
    lw.record_load(spark, root, "001", "insert", "u", rows_out=7)
    old = spark.read.parquet(f"{root}/load_id=002").drop("target", "load_id").withColumn("target", F.lit("v"))
    old.write.parquet(f"{root}/load_id=003")
    history = lw.load_history(spark, root).select("load_id", "target", "rows_out")
    assert rows(history) == {("001", "t", 2): 1, ("001", "u", 7): 1, ("002", "t", None): 1, ("003", "v", None): 1}


# --- intermediate storage ----------------------------------------------------


def test_materialize_cuts_the_plan(spark):
    df = spark.range(10).select((F.col("id") * 2).alias("x"))
    cut = lw.materialize(df)
    assert rows(cut) == rows(df)
    assert "ExistingRDD" in final_plan(cut) and "Range" not in final_plan(cut)


def test_intermediate_data_goes_to_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert lw.shared_dir(spark) == named.rstrip("/")
    staged = lw.stage(spark.range(3), "here")
    assert staged.inputFiles()[0].startswith(f"file://{named}") or named in staged.inputFiles()[0]
    assert staged.count() == 3
