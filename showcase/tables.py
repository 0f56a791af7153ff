"""Warehouse tables: reads, inserts with hooks, layouts, lifecycle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import lakeweir as lw
from showcase.common import scratch_schema, table, workspace


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
    )


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )


CUSTOMERS = "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer"
SUPPLIERS = "SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier"


def _party_table(spark: SparkSession, sf_dir: str, label: str) -> str:
    name = f"{scratch_schema(spark, label)}.party"
    lw.insert_table(_customers(spark, sf_dir), name, "append")
    return name


def read_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{scratch_schema(spark, 'read_table')}.customer"
    lw.save_table(table(spark, sf_dir, "customer"), name)
    return lw.read_table(spark, name)


READ_TABLE = "SELECT * FROM customer"


def read_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = scratch_schema(spark, "read_query")
    for name in ("customer", "orders"):
        df = table(spark, sf_dir, name)
        lw.register_table(spark, f"{schema}.{name}", f"{sf_dir}/{name}.parquet", df.schema)
    return lw.read_query(
        spark,
        f"""
        SELECT c_mktsegment, count(*) AS n_orders, max(o_orderdate) AS last_order
        FROM {schema}.orders JOIN {schema}.customer ON o_custkey = c_custkey
        GROUP BY c_mktsegment""",
    )


READ_QUERY = """
SELECT c_mktsegment, count(*) AS n_orders, max(o_orderdate) AS last_order
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment"""


def insert_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _party_table(spark, sf_dir, "insert_append")
    lw.insert_table(_suppliers(spark, sf_dir), name, "append")
    return lw.read_table(spark, name)


INSERT_APPEND = f"{CUSTOMERS} UNION ALL {SUPPLIERS}"


def insert_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rows only, in the columns and types the table was declared with."""
    name = f"{scratch_schema(spark, 'insert_overwrite')}.party"
    spark.sql(f"CREATE TABLE {name} (id BIGINT, name VARCHAR(40), balance DOUBLE) USING parquet")
    lw.insert_table(_customers(spark, sf_dir), name, "overwrite")
    narrower = _suppliers(spark, sf_dir).withColumn("id", F.col("id").cast("int"))
    lw.insert_table(narrower.select("balance", "name", "id"), name, "overwrite")
    return lw.read_table(spark, name)


INSERT_OVERWRITE = SUPPLIERS


def insert_pre_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _party_table(spark, sf_dir, "insert_pre_sql")
    lw.insert_table(
        _suppliers(spark, sf_dir), name, "append", pre_sql=f"TRUNCATE TABLE {name}"
    )
    return lw.read_table(spark, name)


INSERT_PRE_SQL = SUPPLIERS


def insert_post_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch is staged; the statements move on what they choose."""
    name = _party_table(spark, sf_dir, "insert_post_sql")
    lw.insert_table(
        _suppliers(spark, sf_dir),
        name,
        "append",
        post_sql=[
            f"INSERT INTO {name} SELECT -id, name, balance FROM STG_party WHERE balance < 0",
            f"INSERT INTO {name} SELECT id, upper(name), balance FROM STG_party WHERE balance >= 0",
        ],
    )
    return lw.read_table(spark, name)


INSERT_POST_SQL = f"""
WITH stg AS ({SUPPLIERS})
{CUSTOMERS}
UNION ALL SELECT -id, name, balance FROM stg WHERE balance < 0
UNION ALL SELECT id, upper(name), balance FROM stg WHERE balance >= 0"""


def insert_temp_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two working tables with one hash layout: joined without an exchange."""
    schema = scratch_schema(spark, "insert_temp")
    orders, lines = f"{schema}.orders", f"{schema}.lines"
    lw.write_temp_table(
        table(spark, sf_dir, "orders"), orders, hash_column="o_orderkey", buckets=8
    )
    lw.write_temp_table(
        table(spark, sf_dir, "lineitem"), lines, hash_column="l_orderkey", buckets=8
    )
    joined = spark.table(lines).join(
        spark.table(orders), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return joined.select("o_orderkey", "o_orderpriority", "l_linenumber", "l_quantity")


INSERT_TEMP_CLUSTERED = """
SELECT o_orderkey, o_orderpriority, l_linenumber, l_quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def insert_temp_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{scratch_schema(spark, 'insert_even')}.orders"
    lw.write_temp_table(table(spark, sf_dir, "orders"), name)
    return lw.read_table(spark, name)


INSERT_TEMP_EVEN = "SELECT * FROM orders"


def table_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """External table, dropped with its schema and registered again; its loads."""
    root = workspace(spark, "lifecycle")
    orders = table(spark, sf_dir, "orders")
    schema = scratch_schema(spark, "lifecycle")
    name = f"{schema}.orders"
    for load_id in ("first", "second"):
        lw.write_path(orders, f"{root}/orders", fmt="parquet", mode="append")
        lw.register_table(spark, name, f"{root}/orders", orders.schema)
        spark.catalog.refreshTable(name)
        rows = lw.table_count(spark, name).collect()[0]["rows"]
        lw.record_load(spark, f"{root}/history", load_id, "append", "orders", rows_out=rows)
    lw.drop_schema(spark, schema)
    lw.create_schema(spark, schema)
    lw.register_table(spark, name, f"{root}/orders", orders.schema)
    history = lw.load_history(spark, f"{root}/history")
    now = lw.table_count(spark, name).select(
        F.lit("now").alias("load_id"),
        F.lit("count").alias("operation"),
        F.lit("orders").alias("target"),
        F.col("rows").alias("rows_out"),
    )
    return history.select("load_id", "operation", "target", "rows_out").unionByName(now)


TABLE_LIFECYCLE = """
WITH n AS (SELECT count(*) AS n FROM orders)
SELECT 'first' AS load_id, 'append' AS operation, 'orders' AS target, n AS rows_out FROM n
UNION ALL SELECT 'second', 'append', 'orders', 2 * n FROM n
UNION ALL SELECT 'now', 'count', 'orders', 2 * n FROM n"""


def materialized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A checkpointed frame, used twice."""
    lines = table(spark, sf_dir, "lineitem")
    per_order = lw.materialize(
        lines.groupBy("l_orderkey").agg(
            F.count(F.lit(1)).alias("n_lines"), F.max("l_shipdate").alias("last_ship")
        )
    )
    busiest = per_order.agg(F.max("n_lines").alias("n_lines"))
    return per_order.join(busiest, "n_lines").select("l_orderkey", "n_lines", "last_ship")


MATERIALIZED = """
WITH p AS (SELECT l_orderkey, count(*) AS n_lines, max(l_shipdate) AS last_ship
           FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, n_lines, last_ship FROM p WHERE n_lines = (SELECT max(n_lines) FROM p)"""


ENTRIES = {
    "read_table": (read_table, READ_TABLE),
    "read_query": (read_query, READ_QUERY),
    "insert_append": (insert_append, INSERT_APPEND),
    "insert_overwrite": (insert_overwrite, INSERT_OVERWRITE),
    "insert_pre_sql": (insert_pre_sql, INSERT_PRE_SQL),
    "insert_post_sql": (insert_post_sql, INSERT_POST_SQL),
    "insert_temp_clustered": (insert_temp_clustered, INSERT_TEMP_CLUSTERED),
    "insert_temp_even": (insert_temp_even, INSERT_TEMP_EVEN),
    "table_lifecycle": (table_lifecycle, TABLE_LIFECYCLE),
    "materialized": (materialized, MATERIALIZED),
}
