"""Complete batch and stream loads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import lakeweir as lw
from showcase.common import scratch_schema, table, workspace
from showcase.merges import ORDER_BATCH, order_batch

LOAD_TIME = dt.datetime(2024, 2, 3, 4, 5, 6, tzinfo=dt.timezone.utc)


def _in_utc(df: DataFrame) -> DataFrame:
    moment = F.to_utc_timestamp("ELT_Timestamp", F.current_timezone())
    return df.withColumn("ELT_Timestamp", moment.cast("timestamp_ntz"))


def _zones(root: str) -> dict[str, str]:
    return {"raw": f"{root}/raw", "curated1": f"{root}/curated1"}


def job_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two Parquet files into one warehouse table: first load, then a merge."""
    root, schema = workspace(spark, "job_batch"), scratch_schema(spark, "job_batch")
    orders = table(spark, sf_dir, "orders")
    lw.write_path(orders.unionAll(orders), f"{root}/raw/acme/day1/orders.parquet")
    lw.write_path(order_batch(orders), f"{root}/raw/acme/day2/orders.parquet")
    for number, day in enumerate(("day1", "day2"), start=1):
        lw.ingest_batch(
            spark,
            lw.BatchSpec(
                zones=_zones(root),
                container="acme",
                folder=day,
                file="orders.parquet",
                instance_id=number,
                load_time=LOAD_TIME,
                table=f"{schema}.orders",
                table_root=f"{root}/warehouse/orders",
                merge="newest",
                keys="o_orderkey",
                recency="o_orderdate",
                curated_folder=day,
                curated_file="orders",
                batch_id=day,
            ),
        )
    merged = _in_utc(spark.table(f"{schema}.orders"))
    # The file column holds a path of this run; only its last parts are fixed.
    return merged.withColumn("ELT_SourceFile", F.substring_index("ELT_SourceFile", "/", -4))


JOB_BATCH = f"""
WITH t AS (SELECT *, CAST(1 AS INTEGER) AS "ELT_TransformInstanceID",
                  'raw/acme/day1/orders.parquet' AS "ELT_SourceFile",
                  TIMESTAMP '2024-02-03 04:05:06' AS "ELT_Timestamp" FROM orders),
s AS (SELECT DISTINCT *, CAST(2 AS INTEGER) AS "ELT_TransformInstanceID",
             'raw/acme/day2/orders.parquet' AS "ELT_SourceFile",
             TIMESTAMP '2024-02-03 04:05:06' AS "ELT_Timestamp" FROM ({ORDER_BATCH})),
t1 AS (SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s
       WHERE s.o_orderkey = t.o_orderkey AND s.o_orderdate >= t.o_orderdate)),
s1 AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t1
       WHERE t1.o_orderkey = s.o_orderkey AND t1.o_orderdate > s.o_orderdate))
SELECT * FROM t1 UNION ALL SELECT * FROM s1"""


def job_soft(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``job_batch`` with history kept in the table."""
    root, schema = workspace(spark, "job_soft"), scratch_schema(spark, "job_soft")
    orders = table(spark, sf_dir, "orders")
    lw.write_path(orders, f"{root}/raw/acme/day1/orders.parquet")
    lw.write_path(order_batch(orders), f"{root}/raw/acme/day2/orders.parquet")
    for day in ("day1", "day2"):
        lw.ingest_batch(
            spark,
            lw.BatchSpec(
                zones=_zones(root),
                container="acme",
                folder=day,
                file="orders.parquet",
                load_time=LOAD_TIME,
                table=f"{schema}.orders",
                table_root=f"{root}/warehouse/orders",
                merge="soft",
                keys=["o_orderkey"],
                recency="o_orderdate",
                batch_id=day,
            ),
        )
    return spark.table(f"{schema}.orders").select(*orders.columns, "ELT_ActiveFlag")


JOB_SOFT = f"""
WITH s AS (SELECT DISTINCT * FROM ({ORDER_BATCH}))
SELECT t.*, CASE WHEN EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey
         AND s.o_orderdate >= t.o_orderdate) THEN 0 ELSE 1 END AS "ELT_ActiveFlag"
FROM orders t
UNION ALL
SELECT s.*, CASE WHEN EXISTS (SELECT 1 FROM orders t WHERE t.o_orderkey = s.o_orderkey
         AND t.o_orderdate > s.o_orderdate) THEN 0 ELSE 1 END
FROM s"""


def job_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV appended to a table and written to the lake as CSV; the lake side."""
    root, schema = workspace(spark, "job_insert"), scratch_schema(spark, "job_insert")
    supplier = table(spark, sf_dir, "supplier")
    lw.write_path(supplier, f"{root}/raw/acme/supplier.csv", fmt="csv", sep="|")
    spec = lw.BatchSpec(
        zones=_zones(root),
        container="acme",
        file="supplier.csv",
        sep="|",
        header="TRUE",
        load_time=LOAD_TIME,
        table=f"{schema}.supplier",
        curated_folder="supplier",
        curated_format="csv",
        target_schema=supplier.schema,
    )
    lw.ingest_batch(spark, spec)
    lake = lw.read_path(spark, f"{root}/curated1/acme/supplier", "csv", schema=supplier.schema)
    warehouse = spark.table(f"{schema}.supplier").select(*supplier.columns)
    return warehouse.withColumn("side", F.lit("table")).unionByName(
        lake.withColumn("side", F.lit("lake"))
    )


JOB_INSERT = """
SELECT *, 'table' AS side FROM supplier UNION ALL SELECT *, 'lake' FROM supplier"""


def job_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested JSON lines, flattened, with tenant column, to Parquet."""
    root = workspace(spark, "job_json")
    events = table(spark, sf_dir, "events")
    nested = events.select(
        "event_id",
        F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("last action")).alias(
            "user"
        ),
        F.array(F.struct(F.col("value").alias("amount"), F.col("props").alias("note"))).alias(
            "item"
        ),
    )
    lw.write_path(nested, f"{root}/raw/acme/events.json", fmt="json")
    lw.ingest_batch(
        spark,
        lw.BatchSpec(
            zones=_zones(root),
            container="acme",
            file="events.json",
            flatten=True,
            tenant="acme",
            instance_id="",
            load_time=LOAD_TIME,
            curated_folder="events",
        ),
    )
    return lw.read_path(spark, f"{root}/curated1/acme/events", "parquet").select(
        "event_id",
        "user_id",
        "user_lastaction",
        "item_amount",
        "item_note",
        "company_code",
        "ELT_TransformInstanceID",
    )


JOB_JSON = """
SELECT event_id, user_id, event_type AS user_lastaction, value AS item_amount,
       props AS item_note, 'ACME' AS company_code,
       CAST(NULL AS INTEGER) AS "ELT_TransformInstanceID" FROM events"""


def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load of all line items, each given twice, reports."""
    root, schema = workspace(spark, "load_metrics"), scratch_schema(spark, "load_metrics")
    lines = table(spark, sf_dir, "lineitem")
    lw.write_path(lines.unionAll(lines), f"{root}/raw/acme/lineitem.parquet")
    result = lw.ingest_batch(
        spark,
        lw.BatchSpec(
            zones=_zones(root),
            container="acme",
            file="lineitem.parquet",
            table=f"{schema}.lineitem",
            history_root=f"{root}/history",
            batch_id="load",
        ),
    )
    recorded = lw.load_history(spark, f"{root}/history").where(F.col("load_id") == "load")
    counts = ["operation", "raw_count", "source_count", "transform_count", "rows_out"]
    return result.to_frame(spark).select(*counts).unionByName(recorded.select(*counts))


LOAD_METRICS = """
WITH d AS (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM lineitem)),
r AS (SELECT 2 * count(*) AS n FROM lineitem),
one AS (SELECT 'insert append' AS operation, r.n AS raw_count, d.n AS source_count,
               d.n AS transform_count, d.n AS rows_out FROM d, r)
SELECT * FROM one UNION ALL SELECT * FROM one"""


def job_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge into a partitioned table that rewrites the days it touches."""
    root, schema = workspace(spark, "job_parts"), scratch_schema(spark, "job_parts")
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "value", F.dayofmonth("ts").alias("day")
    )
    late = events.where(F.col("day") > 20).select(
        "event_id",
        F.expr("ts + make_dt_interval(0, CAST(user_id % 3 - 1 AS INT))").alias("ts"),
        "user_id",
        (F.col("value") + 1).alias("value"),
        "day",
    )
    lw.write_path(events, f"{root}/raw/acme/all/events.parquet")
    lw.write_path(late, f"{root}/raw/acme/late/events.parquet")
    for part in ("all", "late"):
        lw.ingest_batch(
            spark,
            lw.BatchSpec(
                zones=_zones(root),
                container="acme",
                folder=part,
                file="events.parquet",
                load_time=LOAD_TIME,
                table=f"{schema}.events",
                table_root=f"{root}/warehouse/events",
                merge="newest",
                keys="event_id",
                recency="ts",
                partition_by="day",
                keys_fix_partition=True,
                batch_id=part,
            ),
        )
    return spark.table(f"{schema}.events").select("event_id", "ts", "user_id", "value", "day")


JOB_PARTITIONS = """
WITH t AS (SELECT event_id, ts, user_id, value, CAST(day(ts) AS INTEGER) AS day FROM events),
s AS (SELECT event_id, ts + to_hours(CAST(user_id % 3 - 1 AS INTEGER)) AS ts, user_id,
             value + 1 AS value, day FROM t WHERE day > 20)
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.event_id = t.event_id AND s.ts >= t.ts)
UNION ALL
SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.event_id = s.event_id AND t.ts > s.ts)"""


def job_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON stream to a registered table that gains a column with the second run."""
    root, schema = workspace(spark, "job_stream"), scratch_schema(spark, "job_stream")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    )
    closed = orders.where(F.col("o_orderstatus") == "F").drop("o_orderpriority")
    still_open = orders.where(F.col("o_orderstatus") != "F")
    for number, drop in enumerate((closed, still_open)):
        drop.write.json(f"{root}/in/{number}")
        lw.ingest_stream(
            spark,
            lw.StreamSpec(
                source=f"{root}/in",
                fmt="json",
                path=f"{root}/out",
                checkpoint=f"{root}/checkpoint",
                schema_path=f"{root}/schema",
                table=f"{schema}.orders",
            ),
        )
    return lw.read_query(
        spark,
        f"""
        SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders,
               count(DISTINCT o_custkey) AS n_customers
        FROM {schema}.orders GROUP BY o_orderstatus, o_orderpriority""",
    )


JOB_STREAM = """
SELECT o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END
         AS o_orderpriority,
       count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers
FROM orders GROUP BY 1, 2"""


ENTRIES = {
    "job_batch": (job_batch, JOB_BATCH),
    "job_soft": (job_soft, JOB_SOFT),
    "job_insert": (job_insert, JOB_INSERT),
    "job_json": (job_json, JOB_JSON),
    "job_partitions": (job_partitions, JOB_PARTITIONS),
    "job_stream": (job_stream, JOB_STREAM),
    "load_metrics": (load_metrics, LOAD_METRICS),
}
