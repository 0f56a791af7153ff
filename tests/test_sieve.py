"""Rows that a batch cannot touch stay out of its merge."""

import pytest
from pyspark.sql import functions as F

import lakeweir as lw
from tests.helpers import rows

BITS = 1 << 15


def union_branches(plan):
    """The children of the first union of a plan as text, without the plans of subqueries."""
    kept, inside = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if inside is not None and depth > inside:
            continue
        inside = depth if line.lstrip(" :+-").startswith(("Subquery", "ReusedSubquery")) else None
        if inside is None:
            kept.append((depth, line))
    top = next(i for i, (_, line) in enumerate(kept) if line.endswith("+- Union"))
    branches = []
    for depth, line in kept[top + 1 :]:
        if depth <= kept[top][0]:
            break
        if depth == kept[top][0] + 3:
            branches.append([])
        branches[-1].append(line)
    return ["\n".join(b) for b in branches]


@pytest.fixture
def sides(spark, tmp_path):
    """A target with a hot key, null keys and many keys that the batch has not."""
    key = F.expr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id END").alias("k")
    wide = F.sha2(F.col("id").cast("string"), 512).alias("payload")
    moment = (F.col("id") % 11).cast("int").alias("moment")
    target = spark.range(0, 30_000, 1, 8).select(key, F.concat(F.lit("s"), F.col("id") % 4).alias("k2"), moment, wide)
    batch = spark.range(0, 900).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id * 40 END").alias("k"),
        F.concat(F.lit("s"), F.col("id") % 4).alias("k2"), (F.col("id") % 7 + 3).cast("int").alias("moment"), wide,
    )
    for name, df in (("target", target), ("batch", batch)):
        df.write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / "target")), spark.read.parquet(str(tmp_path / "batch"))


@pytest.mark.parametrize("keys", ["k", "k|k2"])
@pytest.mark.parametrize("bits", [BITS, 1 << 20])
def test_no_match_is_lost_and_most_others_are_told(sides, keys, bits):
    target, batch = sides
    near, far = lw.split_by_keys(target, batch, keys, bits)
    assert rows(near) + rows(far) == rows(target)
    names = keys.split("|")
    assert far.join(batch, names, "left_semi").count() == 0
    untouched = target.join(batch, names, "left_anti")
    assert far.count() > 0.95 * untouched.count()
    assert near.where("k IS NULL").count() == 0


@pytest.mark.parametrize("merge", ["upsert", "plain", "soft", "replace"])
def test_a_sifted_merge_equals_the_merge(sides, merge):
    target, batch = sides
    run = {
        "upsert": lambda **o: lw.upsert(target, batch, "k", "moment", **o),
        "plain": lambda **o: lw.upsert(target, batch, "k", **o),
        "soft": lambda **o: lw.upsert_soft(target.withColumn("ELT_ActiveFlag", F.lit(1)), batch, "k", "moment", **o),
        "replace": lambda **o: lw.replace_keys(target, batch, "k", **o),
    }[merge]
    assert rows(run(sift=True)) == rows(run())


def test_untouched_rows_pass_no_exchange(conf, sides):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    target, batch = sides
    merged = lw.upsert(target, batch, "k", "moment", sift=True)
    merged.collect()
    first, *others = union_branches(merged._jdf.queryExecution().executedPlan().toString())
    assert "payload" in first and "FileScan" in first and "Exchange" not in first and "Join" not in first, first
    assert any("Exchange" in x for x in others)


def test_empty_batches_and_wrong_use(spark, sides):
    target, batch = sides
    near, far = lw.split_by_keys(target, batch.limit(0), "k")
    assert near.count() == 0 and far.count() == target.count()
    assert rows(lw.upsert(target.limit(0), batch, "k", "moment", sift=True)) == rows(batch)
    with pytest.raises(ValueError, match="bigint here and string"):
        lw.may_match(target, batch.withColumn("k", F.col("k").cast("string")), "k")
    with pytest.raises(ValueError, match="power of two"):
        lw.may_match(target, batch, "k", bits=40_000)
    with pytest.raises(ValueError, match="key column"):
        lw.may_match(target, batch, "")


def test_awkward_key_names_and_kinds(spark):
    target = spark.createDataFrame([(0.0, "t"), (float("nan"), "u"), (2.5, "v"), (None, "w")], "`a.key` double, tag string")
    batch = spark.createDataFrame([(-0.0, "x"), (float("nan"), "y"), (None, "z")], "`a.key` double, tag string")
    assert rows(lw.replace_keys(target, batch, "a.key", sift=True).select("tag")) == rows(
        lw.replace_keys(target, batch, "a.key").select("tag")
    )
