"""Incremental loads: files arrive in two drops, with a restart between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import lakeweir as lw
from showcase.common import scratch_schema, table, workspace
from showcase.merges import ORDER_BATCH, UPSERT_NEWEST, order_batch


def _drops(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All events, as those of the first half of the month and the later ones."""
    events = table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    return events.where(early), events.where(~early)


def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV drops with spaces in their headers; the third run finds nothing new."""
    root = workspace(spark, "stream_append")
    exact = {
        "escape": '"',
        "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
        "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    }
    for number, drop in enumerate(_drops(spark, sf_dir)):
        spaced = drop.withColumnsRenamed({"event_id": "event id", "user_id": "user id"})
        spaced.write.options(header=True, **exact).csv(f"{root}/in/2024/{number}")
        for _ in range(number + 1):
            stream = lw.file_stream(
                spark, f"{root}/in", "csv", f"{root}/schema", options=exact
            )
            lw.append_stream(stream, f"{root}/out", f"{root}/checkpoint")
    out = spark.read.parquet(f"{root}/out")
    return out.select(
        F.col("eventid").cast("long").alias("event_id"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("userid").cast("long").alias("user_id"),
        "event_type",
        "value",
        "props",
    )


STREAM_APPEND = "SELECT * FROM events"


def stream_json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per file, over several lines; increments of few files."""
    root = workspace(spark, "stream_json")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    # Documents hold at most ten thousand orders each.
    orders.groupBy(F.expr("o_orderkey DIV 10000").alias("slice")).agg(
        F.to_json(F.collect_list(F.struct("*")), {"pretty": "true"}).alias("value")
    ).select("value", F.col("slice").cast("string").alias("slice")).write.partitionBy(
        "slice"
    ).option("maxRecordsPerFile", 1).text(f"{root}/in")
    stream = lw.file_stream(
        spark, f"{root}/in", "json", f"{root}/schema", multiline=True, max_files=5
    )
    lw.append_stream(stream, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out").select(
        "o_orderkey", "o_custkey", "o_orderpriority"
    )


STREAM_JSON_DOCUMENTS = "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders"


def stream_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second drop brings a column that the first one lacked."""
    root = workspace(spark, "stream_evolve")
    first, second = _drops(spark, sf_dir)
    wanted = ["event_id", "user_id", "event_type"]
    for number, drop in enumerate((first.select(*wanted), second.select(*wanted, "value"))):
        drop.write.json(f"{root}/in/{number}")
        stream = lw.file_stream(spark, f"{root}/in", "json", f"{root}/schema")
        lw.append_stream(stream, f"{root}/out", f"{root}/checkpoint")
    schema = lw.load_schema(spark, f"{root}/schema")
    return spark.read.schema(schema).parquet(f"{root}/out").select(*wanted, "value")


STREAM_EVOLVE = """
SELECT event_id, user_id, event_type,
       CASE WHEN ts < TIMESTAMP '2024-01-16' THEN NULL ELSE value END AS value FROM events"""


CHECKED_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def _validated(spark: SparkSession, sf_dir: str) -> str:
    """Load events whose error values are text; returns the folder of the run."""
    root = workspace(spark, "stream_validate")
    for number, drop in enumerate(_drops(spark, sf_dir)):
        value = F.when(F.col("value") < 10, F.concat(F.lit("n/a "), "event_type")).otherwise(
            F.col("value").cast("string")
        )
        drop.select("event_id", "user_id", "event_type", value.alias("value")).write.option(
            "header", True
        ).csv(f"{root}/in/{number}")
        lw.ingest_stream(
            spark,
            lw.StreamSpec(
                source=f"{root}/in",
                fmt="csv",
                path=f"{root}/out",
                checkpoint=f"{root}/checkpoint",
                schema_path=f"{root}/schema",
                target_schema=CHECKED_EVENTS,
                reject_path=f"{root}/rejects",
                history_root=f"{root}/history",
                batch_id=f"run{number}",
            ),
        )
    return root


def stream_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lw.read_increments(spark, f"{_validated(spark, sf_dir)}/out", CHECKED_EVENTS)


STREAM_VALIDATE = """
SELECT event_id, user_id, event_type, value FROM events WHERE value >= 10"""


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _validated(spark, sf_dir)
    rejects = spark.read.parquet(f"{root}/rejects")
    return rejects.select("event_id", F.inline("rejected_values"))


STREAM_REJECTS = """
SELECT event_id, 'value' AS "column", 'n/a ' || event_type AS value FROM events WHERE value < 10"""


def stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _validated(spark, sf_dir)
    return lw.load_history(spark, f"{root}/history").select(
        F.concat(F.lit("run"), F.split_part("load_id", F.lit("-"), F.lit(-1))).alias("run"),
        "source_count",
        "transform_count",
        "reject_count",
    )


STREAM_HISTORY = """
SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'run0' ELSE 'run1' END AS run,
       count(*) AS source_count, count(*) FILTER (WHERE value >= 10) AS transform_count,
       count(*) FILTER (WHERE value < 10) AS reject_count
FROM events GROUP BY run"""


def _forget_commit(spark: SparkSession, checkpoint: str, number: int) -> None:
    """What a failure leaves between the end of an increment and the note of it."""
    for name in (f"{number}", f".{number}.crc"):
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/{name}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, False)


def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops merged by key, the second with updates and late rows; both increments come again."""
    root, schema = workspace(spark, "stream_merge"), scratch_schema(spark, "stream_merge")
    orders = table(spark, sf_dir, "orders")
    spec = lw.StreamSpec(
        source=f"{root}/in",
        fmt="parquet",
        path=f"{root}/versions",
        checkpoint=f"{root}/checkpoint",
        schema=orders.schema,
        table=f"{schema}.orders",
        merge="newest",
        keys="o_orderkey",
        recency="o_orderdate",
    )
    for number, drop in enumerate((orders, order_batch(orders))):
        drop.write.parquet(f"{root}/in/{number}")
        lw.ingest_stream(spark, spec)
        _forget_commit(spark, spec.checkpoint, number)
        lw.ingest_stream(spark, spec)
    return spark.table(f"{schema}.orders")


STREAM_MERGE = UPSERT_NEWEST


def stream_merge_soft(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``stream_merge`` from JSON, with history kept and misfits moved away."""
    root, schema = workspace(spark, "stream_merge_soft"), scratch_schema(spark, "stream_merge_soft")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    late = order_batch(table(spark, sf_dir, "orders")).select(*orders.columns)
    bad = orders.limit(1).select(
        F.lit("no number").alias("o_orderkey"), "o_orderstatus", F.col("o_orderdate").cast("string")
    )
    drops = [df.withColumns({c: F.col(c).cast("string") for c in df.columns}) for df in (orders, late)]
    spec = lw.StreamSpec(
        source=f"{root}/in",
        fmt="json",
        path=f"{root}/versions",
        checkpoint=f"{root}/checkpoint",
        schema_path=f"{root}/schema",
        target_schema=orders.schema,
        reject_path=f"{root}/rejects",
        table=f"{schema}.orders",
        merge="soft",
        keys="o_orderkey",
        recency="o_orderdate",
    )
    for number, drop in enumerate(drops):
        drop.unionByName(bad).write.json(f"{root}/in/{number}")
        lw.ingest_stream(spark, spec)
    return spark.table(f"{schema}.orders")


STREAM_MERGE_SOFT = f"""
WITH s AS (SELECT o_orderkey, o_orderstatus, o_orderdate FROM ({ORDER_BATCH}))
SELECT t.o_orderkey, t.o_orderstatus, t.o_orderdate,
       CASE WHEN EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey
         AND s.o_orderdate >= t.o_orderdate) THEN 0 ELSE 1 END AS "ELT_ActiveFlag"
FROM orders t
UNION ALL
SELECT s.*, CASE WHEN EXISTS (SELECT 1 FROM orders t WHERE t.o_orderkey = s.o_orderkey
         AND t.o_orderdate > s.o_orderdate) THEN 0 ELSE 1 END
FROM s"""


ENTRIES = {
    "stream_merge": (stream_merge, STREAM_MERGE),
    "stream_merge_soft": (stream_merge_soft, STREAM_MERGE_SOFT),
    "stream_append": (stream_append, STREAM_APPEND),
    "stream_json_documents": (stream_json_documents, STREAM_JSON_DOCUMENTS),
    "stream_evolve": (stream_evolve, STREAM_EVOLVE),
    "stream_validate": (stream_validate, STREAM_VALIDATE),
    "stream_rejects": (stream_rejects, STREAM_REJECTS),
    "stream_history": (stream_history, STREAM_HISTORY),
}
