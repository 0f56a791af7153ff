"""Merges against the statements they stand for, run one after another in SQL."""

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import lakeweir as lw
from tests.helpers import count_in, final_plan, rows

COLUMNS = "trial int, k1 int, k2 string, moment int, tag string"
CASES = 150


def random_sides(seed):
    """Many small random cases in two tables; the case number is a key column."""
    rng = random.Random(seed)

    def side(trial, label):
        return [
            (
                trial,
                None if rng.random() < 0.1 else rng.randint(1, 3),
                None if rng.random() < 0.1 else rng.choice("ab"),
                None if rng.random() < 0.15 else rng.randint(1, 5),
                f"{label}{i}",
            )
            for i in range(rng.randint(0, 7))
        ]

    target, batch = [], []
    for trial in range(CASES):
        target += side(trial, "t")
        batch += side(trial, "s")
    return target, batch


def sql_tables(target, batch, flags=False):
    con = duckdb.connect()
    for name, data in (("t", target), ("s", batch)):
        con.execute(
            f"CREATE TABLE {name} (trial INTEGER, k1 INTEGER, k2 VARCHAR, moment INTEGER, "
            "tag VARCHAR)"
        )
        con.executemany(f"INSERT INTO {name} VALUES (?, ?, ?, ?, ?)", data)
        if flags:
            con.execute(f"ALTER TABLE {name} ADD COLUMN flag INTEGER DEFAULT 1")
    return con


SAME = "s.trial = t.trial AND s.k1 = t.k1 AND s.k2 = t.k2"


def sql_rows(con):
    from collections import Counter

    return Counter(con.execute("SELECT * FROM t").fetchall())


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("recency", ["moment", None])
def test_upsert_equals_sequential_statements(spark, seed, recency):
    target, batch = random_sides(seed)
    con = sql_tables(target, batch)
    superseded = f"{SAME} AND s.moment >= t.moment" if recency else SAME
    outdated = f"{SAME} AND t.moment > s.moment" if recency else SAME
    con.execute(f"DELETE FROM t WHERE EXISTS (SELECT 1 FROM s WHERE {superseded})")
    con.execute(f"DELETE FROM s WHERE EXISTS (SELECT 1 FROM t WHERE {outdated})")
    con.execute("INSERT INTO t SELECT * FROM s")

    merged = lw.upsert(
        spark.createDataFrame(target, COLUMNS),
        spark.createDataFrame(batch, COLUMNS),
        "trial|k1|k2",
        recency,
    )
    assert rows(merged) == sql_rows(con)


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_soft_upsert_equals_sequential_statements(spark, seed):
    target, batch = random_sides(seed)
    con = sql_tables(target, batch, flags=True)
    con.execute("UPDATE t SET flag = 0 WHERE tag = 't0'")
    con.execute(
        f"UPDATE t SET flag = 0 WHERE EXISTS (SELECT 1 FROM s WHERE {SAME} "
        "AND s.moment >= t.moment)"
    )
    con.execute(
        f"UPDATE s SET flag = 0 WHERE EXISTS (SELECT 1 FROM t WHERE {SAME} "
        "AND t.moment > s.moment)"
    )
    con.execute("INSERT INTO t SELECT * FROM s")

    flagged = spark.createDataFrame(target, COLUMNS).withColumn(
        "flag", F.when(F.col("tag") == "t0", 0).otherwise(1)
    )
    merged = lw.upsert_soft(
        flagged,
        spark.createDataFrame(batch, COLUMNS),
        ["trial", "k1", "k2"],
        "moment",
        flag="flag",
    )
    assert rows(merged) == sql_rows(con)


@pytest.mark.parametrize("seed", [7, 8])
def test_soft_upsert_without_recency_keeps_the_batch_active(spark, seed):
    target, batch = random_sides(seed)
    con = sql_tables(target, batch, flags=True)
    con.execute(f"UPDATE t SET flag = 0 WHERE EXISTS (SELECT 1 FROM s WHERE {SAME})")
    con.execute("INSERT INTO t SELECT * FROM s")
    merged = lw.upsert_soft(
        spark.createDataFrame(target, COLUMNS).withColumn("flag", F.lit(1)),
        spark.createDataFrame(batch, COLUMNS),
        "trial|k1|k2",
        flag="flag",
    )
    assert rows(merged) == sql_rows(con)


@pytest.mark.parametrize("seed", [9])
def test_single_steps_equal_their_statements(spark, seed):
    target, batch = random_sides(seed)
    t, s = spark.createDataFrame(target, COLUMNS), spark.createDataFrame(batch, COLUMNS)
    keys = "trial|k1|k2"

    con = sql_tables(target, batch)
    con.execute(
        f"DELETE FROM t WHERE EXISTS (SELECT 1 FROM s WHERE {SAME} AND s.moment >= t.moment)"
    )
    assert rows(lw.remove_superseded(t, s, keys, "moment")) == sql_rows(con)

    con = sql_tables(batch, target)
    con.execute(
        f"DELETE FROM t WHERE EXISTS (SELECT 1 FROM s WHERE {SAME} AND s.moment > t.moment)"
    )
    assert rows(lw.remove_outdated(s, t, keys, "moment")) == sql_rows(con)


@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_the_join_strategy_does_not_change_results(spark, conf, broadcast):
    conf("spark.sql.autoBroadcastJoinThreshold", broadcast)
    target, batch = random_sides(10)
    con = sql_tables(target, batch)
    con.execute(
        f"DELETE FROM t WHERE EXISTS (SELECT 1 FROM s WHERE {SAME} AND s.moment >= t.moment)"
    )
    con.execute(
        f"DELETE FROM s WHERE EXISTS (SELECT 1 FROM t WHERE {SAME} AND t.moment > s.moment)"
    )
    con.execute("INSERT INTO t SELECT * FROM s")
    t, s = spark.createDataFrame(target, COLUMNS), spark.createDataFrame(batch, COLUMNS)
    for colocated in (False, True):
        merged = lw.upsert(t, s, "trial|k1|k2", "moment", colocated=colocated)
        assert rows(merged) == sql_rows(con)


def side(spark, *moments, tag="x"):
    return spark.createDataFrame([(1, m, tag) for m in moments], "k int, moment int, tag string")


def test_all_rows_of_a_winning_batch_key_go_in(spark):
    merged = lw.upsert(side(spark, 3, tag="t"), side(spark, 5, 1, tag="s"), "k", "moment")
    assert rows(merged) == {(1, 5, "s"): 1, (1, 1, "s"): 1}


def test_ties_go_to_the_batch(spark):
    merged = lw.upsert(side(spark, 3, tag="t"), side(spark, 3, tag="s"), "k", "moment")
    assert rows(merged) == {(1, 3, "s"): 1}


def test_late_batch_rows_are_dropped_or_kept_as_history(spark):
    old, late = side(spark, 3, tag="t"), side(spark, 2, tag="s")
    assert rows(lw.upsert(old, late, "k", "moment")) == {(1, 3, "t"): 1}
    soft = lw.upsert_soft(old.withColumn("ELT_ActiveFlag", F.lit(1)), late, "k", "moment")
    assert rows(soft) == {(1, 3, "t", 1): 1, (1, 2, "s", 0): 1}


def test_dedupe_batch_keeps_the_newest_row_and_all_rows_without_a_key(spark):
    batch = side(spark, 5, 1, None, tag="s").unionAll(
        spark.createDataFrame([(None, 9, "n"), (None, 8, "n")], "k int, moment int, tag string")
    )
    merged = lw.upsert(side(spark, 3, tag="t"), batch, "k", "moment", dedupe_batch=True)
    assert rows(merged) == {(1, 5, "s"): 1, (None, 9, "n"): 1, (None, 8, "n"): 1}


def test_repeating_a_batch_changes_nothing(spark):
    target = spark.createDataFrame([(k, k, "t") for k in range(9)], "k int, moment int, tag string")
    batch = spark.createDataFrame(
        [(k, 4, "s") for k in range(3, 12)], "k int, moment int, tag string"
    )
    once = lw.upsert(target, batch, "k", "moment")
    assert rows(lw.upsert(once, batch, "k", "moment")) == rows(once)


def test_names_with_dots_spaces_and_other_case(spark):
    target = spark.createDataFrame([(1, 1, "t")], "`a.key` int, `the time` int, tag string")
    batch = spark.createDataFrame([("s", 2, 1)], "tag string, `The Time` int, `A.Key` int")
    merged = lw.upsert(target, batch, "a.key", "the time")
    assert rows(merged) == {(1, 2, "s"): 1}
    soft = lw.upsert_soft(target.withColumn("Flag", F.lit(1)), batch, "a.key", flag="flag")
    assert rows(soft) == {(1, 1, "t", 0): 1, (1, 2, "s", 1): 1}


@pytest.mark.parametrize("keys", ["", [], None])
def test_a_merge_needs_keys(spark, keys):
    with pytest.raises(ValueError, match="key column"):
        lw.upsert(side(spark, 1), side(spark, 2), keys)


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="batch has no column"):
        lw.upsert(side(spark, 1), side(spark, 2).drop("k"), "k")
    with pytest.raises(ValueError, match="target has no column"):
        lw.upsert_soft(side(spark, 1), side(spark, 2), "k", "moment")


# --- plans -------------------------------------------------------------------


@pytest.fixture(scope="module")
def merge_files(spark, tmp_path_factory):
    """A target and a batch in several files; key 0 holds a third of each."""
    base = tmp_path_factory.mktemp("merge")
    keyed = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k")
    wide = F.sha2(F.col("id").cast("string"), 512).alias("payload")
    sides = []
    for name, n, cycle in (("target", 60_000, 97), ("batch", 30_000, 89)):
        path = str(base / name)
        spark.range(0, n, 1, 8).select(
            keyed, (F.col("id") % cycle).cast("int").alias("moment"), wide
        ).write.parquet(path)
        sides.append(spark.read.parquet(path))
    return sides


def test_small_batches_are_broadcast_and_the_target_is_not_shuffled(merge_files):
    target, _ = merge_files
    batch = target.where("k BETWEEN 50 AND 60").withColumn("moment", F.expr("moment - k % 2"))
    plan = final_plan(lw.upsert(target, batch, "k", "moment"))
    assert "SortMergeJoin" not in plan
    assert count_in(plan, r"BroadcastHashJoin .*LeftAnti") == 2
    # Only per-key maxima and the keys where the target leads are exchanged.
    assert "payload" not in "".join(
        line for line in plan.splitlines() if "Exchange hashpartitioning" in line
    )
    assert "ReusedExchange" in plan


@pytest.mark.parametrize("merge", ["upsert", "soft", "replace"])
def test_hot_keys_are_split_over_tasks(spark, conf, merge_files, merge):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "100KB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    target, batch = merge_files
    if merge == "upsert":
        merged = lw.upsert(target, batch, "k", "moment")
    elif merge == "soft":
        merged = lw.upsert_soft(target.withColumn("ELT_ActiveFlag", F.lit(1)), batch, "k", "moment")
    else:
        merged = lw.replace_keys(target, batch, "k")
    plan = final_plan(merged)
    wide_joins = count_in(plan, r"SortMergeJoin\(skew=true\) .*Left(Anti|Outer)")
    assert wide_joins == (1 if merge == "replace" else 2), plan


def test_only_needed_columns_are_scanned_for_the_bounds(conf, merge_files):
    target, batch = merge_files
    plan = final_plan(lw.upsert(target, batch, "k", "moment"))
    schemas = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line]
    wide = [s for s in schemas if "payload" in s]
    assert len(wide) == 2, "each side is read in full once"


def test_a_bucketed_target_is_joined_in_place(spark, conf, schema, merge_files):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    target, batch = merge_files
    lw.write_temp_table(target, f"{schema}.target", "k", buckets=8)
    bucketed = spark.table(f"{schema}.target")
    merged = lw.remove_superseded(bucketed, batch, "k", "moment", colocated=True)
    plan = final_plan(merged)
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1, plan  # the reduced batch, into the buckets
    assert rows(merged) == rows(lw.remove_superseded(target, batch, "k", "moment"))


def test_merge_equals_brute_force_on_a_hot_key(spark, merge_files):
    target, batch = (df.toPandas() for df in merge_files)
    newest = batch.groupby("k")["moment"].max()
    keep = ~(target["k"].map(newest) >= target["moment"])
    lead = target[keep].groupby("k")["moment"].max()
    enter = ~(batch["k"].map(lead) > batch["moment"])
    expected = pd.concat([target[keep], batch[enter]])
    merged = lw.upsert(*merge_files, "k", "moment").toPandas()
    order = ["k", "moment", "payload"]
    pd.testing.assert_frame_equal(
        merged.sort_values(order, ignore_index=True),
        expected.sort_values(order, ignore_index=True),
        check_dtype=False,
    )
