"""Merging by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import lakeweir as lw
from showcase.common import table

# --- orders: a batch of corrections with older, equal and newer dates --------

# Low-priority rows of the batch get a key that no target row has.
ORDER_BATCH = """
    SELECT CASE WHEN o_orderpriority = '5-LOW' THEN -1 - o_orderkey ELSE o_orderkey END
             AS o_orderkey,
           o_custkey, 'U' AS o_orderstatus, o_totalprice,
           o_orderdate + to_days(CAST(o_orderkey % 5 - 2 AS INTEGER)) AS o_orderdate,
           o_orderpriority
    FROM orders"""


def order_batch(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.when(F.col("o_orderpriority") == "5-LOW", -1 - F.col("o_orderkey"))
        .otherwise(F.col("o_orderkey"))
        .alias("o_orderkey"),
        "o_custkey",
        F.lit("U").alias("o_orderstatus"),
        "o_totalprice",
        F.expr("o_orderdate + make_dt_interval(CAST(o_orderkey % 5 - 2 AS INT))").alias(
            "o_orderdate"
        ),
        "o_orderpriority",
    )


def upsert_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return lw.upsert(orders, order_batch(orders), "o_orderkey", "o_orderdate")


UPSERT_NEWEST = f"""
WITH s AS ({ORDER_BATCH}),
t1 AS (SELECT * FROM orders t WHERE NOT EXISTS (SELECT 1 FROM s
       WHERE s.o_orderkey = t.o_orderkey AND s.o_orderdate >= t.o_orderdate)),
s1 AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t1
       WHERE t1.o_orderkey = s.o_orderkey AND t1.o_orderdate > s.o_orderdate))
SELECT * FROM t1 UNION ALL SELECT * FROM s1"""


# --- events: many rows per key on both sides, null keys, null moments --------

EVENT_SIDES = """
t AS (SELECT event_id, nullif(user_id, 8) AS user_id, event_type,
             CASE WHEN value < 1 THEN NULL ELSE ts END AS ts, value
      FROM events),
s AS (SELECT -1 - event_id AS event_id, nullif(user_id, 9) AS user_id, event_type,
             CASE WHEN value < 2 THEN NULL
                  ELSE ts + to_hours(CAST(user_id % 7 - 3 AS INTEGER)) END AS ts, value
      FROM events)"""


def event_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf_dir, "events")
    target = events.select(
        "event_id",
        F.nullif("user_id", F.lit(8)).alias("user_id"),
        "event_type",
        F.when(F.col("value") >= 1, F.col("ts")).alias("ts"),
        "value",
    )
    shifted = F.expr("ts + make_dt_interval(0, CAST(user_id % 7 - 3 AS INT))")
    batch = events.select(
        (-1 - F.col("event_id")).alias("event_id"),
        F.nullif("user_id", F.lit(9)).alias("user_id"),
        "event_type",
        F.when(F.col("value") >= 2, shifted).alias("ts"),
        "value",
    )
    return target, batch


EVENT_KEYS = "user_id|event_type"


def upsert_newest_dup_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = event_sides(spark, sf_dir)
    return lw.upsert(target, batch, EVENT_KEYS, "ts")


UPSERT_NEWEST_DUP_BATCH = f"""
WITH {EVENT_SIDES},
t1 AS (SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s
       WHERE s.user_id = t.user_id AND s.event_type = t.event_type AND s.ts >= t.ts)),
s1 AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t1
       WHERE t1.user_id = s.user_id AND t1.event_type = s.event_type AND t1.ts > s.ts))
SELECT * FROM t1 UNION ALL SELECT * FROM s1"""


def remove_superseded(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = event_sides(spark, sf_dir)
    return lw.remove_superseded(target, batch, EVENT_KEYS, "ts")


REMOVE_SUPERSEDED = f"""
WITH {EVENT_SIDES}
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s
  WHERE s.user_id = t.user_id AND s.event_type = t.event_type AND s.ts >= t.ts)"""


def remove_outdated(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = event_sides(spark, sf_dir)
    return lw.remove_outdated(batch, target, EVENT_KEYS, "ts")


REMOVE_OUTDATED = f"""
WITH {EVENT_SIDES}
SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t
  WHERE t.user_id = s.user_id AND t.event_type = s.event_type AND t.ts > s.ts)"""


def upsert_soft_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = event_sides(spark, sf_dir)
    active = F.when(F.col("event_type") == "view", 0).otherwise(1)
    return lw.upsert_soft(target.withColumn("ELT_ActiveFlag", active), batch, EVENT_KEYS, "ts")


UPSERT_SOFT_EVENTS = f"""
WITH {EVENT_SIDES}
SELECT t.*, CASE WHEN EXISTS (SELECT 1 FROM s WHERE s.user_id = t.user_id
         AND s.event_type = t.event_type AND s.ts >= t.ts) THEN 0
       WHEN event_type = 'view' THEN 0 ELSE 1 END AS "ELT_ActiveFlag"
FROM t
UNION ALL
SELECT s.*, CASE WHEN EXISTS (SELECT 1 FROM t WHERE t.user_id = s.user_id
         AND t.event_type = s.event_type AND t.ts > s.ts) THEN 0 ELSE 1 END
FROM s"""


def flag_superseded(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = event_sides(spark, sf_dir)
    return lw.flag_superseded(
        target.withColumn("live", F.lit(1)), batch, EVENT_KEYS, "ts", flag="live"
    )


FLAG_SUPERSEDED = f"""
WITH {EVENT_SIDES}
SELECT t.*, CASE WHEN EXISTS (SELECT 1 FROM s WHERE s.user_id = t.user_id
         AND s.event_type = t.event_type AND s.ts >= t.ts) THEN 0 ELSE 1 END AS live FROM t"""


def flag_outdated(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = event_sides(spark, sf_dir)
    return lw.flag_outdated(
        batch.withColumn("live", F.lit(1)), target, EVENT_KEYS, "ts", flag="live"
    )


FLAG_OUTDATED = f"""
WITH {EVENT_SIDES}
SELECT s.*, CASE WHEN EXISTS (SELECT 1 FROM t WHERE t.user_id = s.user_id
         AND t.event_type = s.event_type AND t.ts > s.ts) THEN 0 ELSE 1 END AS live FROM s"""


# --- orders and their shipments: a batch with several rows per key -----------

SHIPMENT_SIDES = """
t AS (SELECT o_orderkey AS order_key, o_orderdate AS moment, o_totalprice AS amount,
             o_orderstatus AS status FROM orders),
s AS (SELECT l_orderkey AS order_key, l_shipdate AS moment, l_extendedprice AS amount,
             l_linestatus AS status FROM lineitem)"""


def shipment_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    target = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_orderdate").alias("moment"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"),
    )
    batch = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_shipdate").alias("moment"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_linestatus").alias("status"),
    )
    return target, batch


NEWEST_BY_ORDER = """
t1 AS (SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s
       WHERE s.order_key = t.order_key AND s.moment >= t.moment)),
s1 AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t1
       WHERE t1.order_key = s.order_key AND t1.moment > s.moment))
SELECT * FROM t1 UNION ALL SELECT * FROM s1"""


def upsert_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = shipment_sides(spark, sf_dir)
    return lw.upsert(target, batch, "order_key", "moment")


UPSERT_SHIPMENTS = f"WITH {SHIPMENT_SIDES}, {NEWEST_BY_ORDER}"


def upsert_latest_shipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = shipment_sides(spark, sf_dir)
    return lw.upsert(target, batch, "order_key", "moment", dedupe_batch=True)


UPSERT_LATEST_SHIPMENT = f"""
WITH {SHIPMENT_SIDES.replace("s AS (", "every AS (")},
s AS (SELECT order_key, moment, amount, status FROM (
        SELECT *, row_number() OVER (PARTITION BY order_key
                  ORDER BY moment DESC, amount DESC, status DESC) AS place FROM every)
      WHERE place = 1),
{NEWEST_BY_ORDER}"""


def upsert_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All returned lines carry one key: it holds a third of both sides."""
    lines = table(spark, sf_dir, "lineitem")
    hot = F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(F.col("l_orderkey"))
    target = lines.select(hot.alias("k"), "l_partkey", "l_shipdate", "l_quantity")
    later = F.expr("l_shipdate + make_dt_interval(CAST(l_linenumber - 4 AS INT))")
    batch = lines.select(
        hot.alias("k"), "l_partkey", later.alias("l_shipdate"), "l_quantity"
    )
    return lw.upsert(target, batch, "k", "l_shipdate")


# The hot key makes row-by-row EXISTS quadratic, so the SQL compares with each
# key's greatest date, which decides the same EXISTS.
UPSERT_HOT_KEY = """
WITH t AS (SELECT CASE WHEN l_returnflag = 'R' THEN -1 ELSE l_orderkey END AS k, l_partkey,
                  l_shipdate, l_quantity FROM lineitem),
s AS (SELECT CASE WHEN l_returnflag = 'R' THEN -1 ELSE l_orderkey END AS k, l_partkey,
             l_shipdate + to_days(CAST(l_linenumber - 4 AS INTEGER)) AS l_shipdate, l_quantity
      FROM lineitem),
t1 AS (SELECT t.* FROM t LEFT JOIN (SELECT k, max(l_shipdate) AS m FROM s GROUP BY k) b USING (k)
       WHERE NOT coalesce(b.m >= t.l_shipdate, false)),
s1 AS (SELECT s.* FROM s LEFT JOIN (SELECT k, max(l_shipdate) AS m FROM t1 GROUP BY k) b USING (k)
       WHERE NOT coalesce(b.m > s.l_shipdate, false))
SELECT * FROM t1 UNION ALL SELECT * FROM s1"""


# --- customers: no recency column -------------------------------------------

CUSTOMER_BATCH = """
s AS (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN -1 - c_custkey ELSE c_custkey END
               AS c_custkey,
             c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, 'MOVED' AS c_mktsegment
      FROM customer)"""


def customer_batch(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.when(F.col("c_mktsegment") == "BUILDING", -1 - F.col("c_custkey"))
        .otherwise(F.col("c_custkey"))
        .alias("c_custkey"),
        "c_name",
        "c_nationkey",
        (F.col("c_acctbal") + 1).alias("c_acctbal"),
        F.lit("MOVED").alias("c_mktsegment"),
    )


def upsert_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return lw.replace_keys(customer, customer_batch(customer), "c_custkey")


UPSERT_REPLACE = f"""
WITH {CUSTOMER_BATCH}
SELECT * FROM customer t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.c_custkey = t.c_custkey)
UNION ALL SELECT * FROM s"""


def upsert_soft_no_recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    target = customer.withColumn("ELT_ActiveFlag", F.lit(1))
    return lw.upsert_soft(target, customer_batch(customer), "c_custkey")


UPSERT_SOFT_NO_RECENCY = f"""
WITH {CUSTOMER_BATCH}
SELECT t.*, CASE WHEN EXISTS (SELECT 1 FROM s WHERE s.c_custkey = t.c_custkey)
       THEN 0 ELSE 1 END AS "ELT_ActiveFlag" FROM customer t
UNION ALL SELECT s.*, 1 FROM s"""


def upsert_soft(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    active = F.when(F.col("o_orderstatus") == "F", 0).otherwise(1)
    target = orders.withColumn("ELT_ActiveFlag", active)
    return lw.upsert_soft(target, order_batch(orders), "o_orderkey", "o_orderdate")


UPSERT_SOFT = f"""
WITH s AS ({ORDER_BATCH})
SELECT t.*, CASE WHEN EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey
         AND s.o_orderdate >= t.o_orderdate) THEN 0
       WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS "ELT_ActiveFlag"
FROM orders t
UNION ALL
SELECT s.*, CASE WHEN EXISTS (SELECT 1 FROM orders t WHERE t.o_orderkey = s.o_orderkey
         AND t.o_orderdate > s.o_orderdate) THEN 0 ELSE 1 END
FROM s"""


def append_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns are matched by name: the batch has them in another order."""
    parties = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    more = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name")
    )
    return lw.append_rows(parties, more)


APPEND_ROWS = """
SELECT c_name AS name, c_acctbal AS balance FROM customer
UNION ALL SELECT s_name, s_acctbal FROM supplier"""


# --- shipments: urgent orders settle their lines; other lines stay out of the merge


def upsert_sifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").cast("long").alias("line"),
        F.col("l_shipdate").alias("moved"),
        F.col("l_quantity").alias("quantity"),
    )
    settled = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(
        F.col("o_orderkey").alias("order_key"),
        F.lit(0).cast("long").alias("line"),
        F.expr("o_orderdate + make_dt_interval(60)").cast(lines.schema["moved"].dataType).alias("moved"),
        F.lit(-1.0).cast(lines.schema["quantity"].dataType).alias("quantity"),
    )
    return lw.upsert(lines, settled, "order_key", "moved", sift=True)


UPSERT_SIFTED = """
WITH t AS (SELECT l_orderkey AS order_key, CAST(l_linenumber AS BIGINT) AS line, l_shipdate AS moved,
                  l_quantity AS quantity FROM lineitem),
s AS (SELECT o_orderkey AS order_key, CAST(0 AS BIGINT) AS line, o_orderdate + to_days(60) AS moved,
             -1.0 AS quantity FROM orders WHERE o_orderpriority = '1-URGENT'),
t1 AS (SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s
       WHERE s.order_key = t.order_key AND s.moved >= t.moved)),
s1 AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t1
       WHERE t1.order_key = s.order_key AND t1.moved > s.moved))
SELECT * FROM t1 UNION ALL SELECT * FROM s1"""


ENTRIES = {
    "upsert_sifted": (upsert_sifted, UPSERT_SIFTED),
    "upsert_newest": (upsert_newest, UPSERT_NEWEST),
    "upsert_newest_dup_batch": (upsert_newest_dup_batch, UPSERT_NEWEST_DUP_BATCH),
    "upsert_shipments": (upsert_shipments, UPSERT_SHIPMENTS),
    "upsert_latest_shipment": (upsert_latest_shipment, UPSERT_LATEST_SHIPMENT),
    "upsert_hot_key": (upsert_hot_key, UPSERT_HOT_KEY),
    "upsert_replace": (upsert_replace, UPSERT_REPLACE),
    "upsert_soft": (upsert_soft, UPSERT_SOFT),
    "upsert_soft_events": (upsert_soft_events, UPSERT_SOFT_EVENTS),
    "upsert_soft_no_recency": (upsert_soft_no_recency, UPSERT_SOFT_NO_RECENCY),
    "remove_superseded": (remove_superseded, REMOVE_SUPERSEDED),
    "remove_outdated": (remove_outdated, REMOVE_OUTDATED),
    "flag_superseded": (flag_superseded, FLAG_SUPERSEDED),
    "flag_outdated": (flag_outdated, FLAG_OUTDATED),
    "append_rows": (append_rows, APPEND_ROWS),
}
