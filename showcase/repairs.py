"""Loads that must keep every column, value and row, and run once however often they are started."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import lakeweir as lw
from showcase.common import scratch_schema, table, workspace
from showcase.loads import LOAD_TIME


class _Loads:
    """A new table and the loads into it."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, workspace(spark, label)
        self.table = f"{scratch_schema(spark, label)}.t"

    def load(self, df: DataFrame, day: str, write: bool = True, **more) -> lw.LoadResult:
        if write:
            lw.write_path(df, f"{self.root}/raw/acme/{day}/in.parquet")
        settings = {
            "zones": {"raw": f"{self.root}/raw", "curated1": f"{self.root}/curated1"},
            "container": "acme",
            "folder": day,
            "file": "in.parquet",
            "load_time": LOAD_TIME,
            "table": self.table,
            "batch_id": day,
        }
        return lw.ingest_batch(self.spark, lw.BatchSpec(**(settings | more)))

    def result(self, *columns: str) -> DataFrame:
        return self.spark.table(self.table).select(*columns)


def job_source_company_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column of the source keeps its values though a load could fill one of that name."""
    loads = _Loads(spark, "job_source_company_code")
    supplier = table(spark, sf_dir, "supplier")
    named = supplier.withColumn("company_code", F.concat(F.lit("s"), "s_nationkey"))
    for day in ("one", "two"):
        loads.load(named, day)
    return loads.result(*named.columns)


JOB_SOURCE_COMPANY_CODE = """
WITH s AS (SELECT *, 's' || s_nationkey AS company_code FROM supplier)
SELECT * FROM s UNION ALL SELECT * FROM s"""


def job_soft_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that arrive as inactive stay so in a table that keeps history."""
    loads = _Loads(spark, "job_soft_flag")
    orders = table(spark, sf_dir, "orders")
    soft = {"merge": "soft", "keys": "o_orderkey", "recency": "o_orderdate"}
    soft["table_root"] = f"{loads.root}/warehouse/t"
    flag = F.when(F.col("o_orderstatus") == "F", 0).otherwise(1)
    loads.load(orders.where("o_orderkey % 2 = 0").withColumn("ELT_ActiveFlag", flag), "one", **soft)
    loads.load(orders.where("o_orderkey % 2 = 1").withColumn("ELT_ActiveFlag", flag), "two", **soft)
    return loads.result(*orders.columns, "ELT_ActiveFlag")


JOB_SOFT_FLAG = """
SELECT *, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS "ELT_ActiveFlag" FROM orders"""


def job_misfits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that do not fit the table wait beside it, with their text and their row."""
    loads = _Loads(spark, "job_misfits")
    parts = table(spark, sf_dir, "part")
    loads.load(parts.where("p_partkey % 2 = 0"), "one")
    half = F.when(F.col("p_partkey") % 3 == 0, F.col("p_size") + 0.5).otherwise(F.col("p_size"))
    late = parts.where("p_partkey % 2 = 1").withColumn("p_size", half)
    rejects = f"{loads.root}/rejects"
    loads.load(late, "two", on_reject="quarantine", reject_path=rejects)
    aside = spark.read.parquet(f"{rejects}/batch_id=two")
    kept = loads.result("p_partkey", F.col("p_size").cast("string").alias("p_size"))
    return kept.withColumn("side", F.lit("table")).unionByName(
        aside.select("p_partkey", F.inline("rejected_values"))
        .select("p_partkey", F.col("value").alias("p_size"))
        .withColumn("side", F.lit("aside"))
    )


JOB_MISFITS = """
SELECT p_partkey, CASE WHEN p_partkey % 2 = 1 AND p_partkey % 3 = 0 THEN p_size || '.5'
         ELSE p_size::VARCHAR END AS p_size,
       CASE WHEN p_partkey % 2 = 1 AND p_partkey % 3 = 0 THEN 'aside' ELSE 'table' END AS side
FROM part"""


def job_extra_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that the table lacks stops the load; nothing of the batch is in the table."""
    loads = _Loads(spark, "job_extra_columns")
    nation = table(spark, sf_dir, "nation")
    loads.load(nation, "one")
    try:
        loads.load(nation.withColumn("n_more", F.lit(1)), "two")
        outcome = "loaded"
    except ValueError as error:
        outcome = "refused" if "n_more" in str(error) else "failed"
    return loads.result(*nation.columns).withColumn("outcome", F.lit(outcome))


JOB_EXTRA_COLUMNS = "SELECT *, 'refused' AS outcome FROM nation"


def job_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads that are started twice under one batch id leave what one run leaves."""
    customer = table(spark, sf_dir, "customer")
    plain = _Loads(spark, "job_repeat")
    for day in ("one", "two"):
        df = customer.where(F.col("c_custkey") % 2 == (0 if day == "one" else 1))
        for attempt in range(2):
            plain.load(df, day, write=not attempt)
    soft = _Loads(spark, "job_repeat_soft")
    how = {"merge": "soft", "keys": "c_custkey", "table_root": f"{soft.root}/warehouse/t"}
    how |= {"partition_by": "c_nationkey", "keys_fix_partition": True}
    soft.load(customer, "one", **how)
    for attempt in range(2):
        soft.load(customer.where("c_custkey % 10 = 0"), "two", write=not attempt, **how)
    return (
        plain.result(*customer.columns)
        .withColumns({"ELT_ActiveFlag": F.lit(1), "load": F.lit("append")})
        .unionByName(
            soft.result(*customer.columns, "ELT_ActiveFlag").withColumn("load", F.lit("soft"))
        )
    )


JOB_REPEAT = """
SELECT *, 1 AS "ELT_ActiveFlag", 'append' AS load FROM customer
UNION ALL SELECT *, CASE WHEN c_custkey % 10 = 0 THEN 0 ELSE 1 END, 'soft' FROM customer
UNION ALL SELECT *, 1, 'soft' FROM customer WHERE c_custkey % 10 = 0"""


def insert_post_sql_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that ends in SQL, started twice under one batch id, moves its rows on once."""
    name = f"{scratch_schema(spark, 'post_sql_repeat')}.supplier"
    supplier = table(spark, sf_dir, "supplier")
    lw.insert_table(supplier.limit(0), name, "append")
    for batch in ("one", "one", "two", "one"):
        part = supplier.where(F.col("s_suppkey") % 2 == (0 if batch == "one" else 1))
        statement = f"INSERT INTO {name} SELECT * FROM STG_supplier WHERE s_acctbal > 0"
        lw.insert_table(part, name, "append", post_sql=statement, batch_id=batch)
    return spark.table(name)


INSERT_POST_SQL_REPEAT = "SELECT * FROM supplier WHERE s_acctbal > 0"


def job_two_tables_one_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables loaded under one batch id, with one history: rows, and what the history says."""
    history = f"{workspace(spark, 'two_tables')}/history"
    counted = []
    for name in ("customer", "supplier"):
        loads = _Loads(spark, f"two_tables_{name}")
        df = table(spark, sf_dir, name)
        loads.load(df, "2024-05-01", history_root=history)
        counted.append(loads.result(*df.columns).agg(F.lit(name).alias("name"), F.count("*").alias("n")))
        loads.load(df, "2024-05-01", write=False, history_root=history)
    said = lw.load_history(spark, history).select("load_id", "target", "rows_out")
    held = counted[0].unionByName(counted[1])
    # A table's schema has a name of this run; the label before it is fixed.
    about = F.regexp_extract("target", "two_tables_([a-z]+)_", 1)
    return held.join(said.select("load_id", about.alias("name"), "rows_out"), "name")


JOB_TWO_TABLES_ONE_BATCH = """
SELECT 'customer' AS name, count(*) AS n, '2024-05-01' AS load_id, count(*) AS rows_out FROM customer
UNION ALL SELECT 'supplier', count(*), '2024-05-01', count(*) FROM supplier"""


def job_repeat_earlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches loaded again after later ones, and one whose first attempt failed after its insert.

    Once into a table laid out by batch, whose batches replace themselves, and once
    into one that keeps a note of each.
    """
    customer = table(spark, sf_dir, "customer")
    out = []
    for by_batch in (True, False):
        loads = _Loads(spark, f"job_repeat_earlier_{int(by_batch)}")
        how = {"by_batch": by_batch, "partition_by": "c_nationkey"}
        parts = {f"b{i}": customer.where(F.col("c_custkey") % 3 == i) for i in range(3)}
        loads.load(parts["b0"], "b0", **how)
        # The lake folder is there already, so the first attempt fails after its insert.
        lw.write_path(parts["b1"], f"{loads.root}/curated1/acme/b1")
        lake = {"curated_folder": "b1", "curated_mode": "error"}
        try:
            loads.load(parts["b1"], "b1", **how, **lake)
        except Exception as error:
            if "PATH_ALREADY_EXISTS" not in str(error):
                raise
        loads.load(parts["b1"], "b1", write=False, **how)
        loads.load(parts["b2"], "b2", **how)
        for earlier in ("b0", "b1", "b0"):
            loads.load(parts[earlier], earlier, write=False, **how)
        out.append(loads.result(*customer.columns).withColumn("by_batch", F.lit(by_batch)))
    return out[0].unionByName(out[1])


JOB_REPEAT_EARLIER = """
SELECT *, true AS by_batch FROM customer UNION ALL SELECT *, false FROM customer"""


def align_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of structs by name; misfits inside arrays are seen."""
    orders = table(spark, sf_dir, "orders")
    made = orders.select(
        "o_orderkey",
        F.struct(F.col("o_custkey").alias("cust"), F.col("o_orderstatus").alias("status")).alias("s"),
        F.array(F.col("o_orderkey").cast("string"), F.col("o_orderpriority")).alias("l"),
    ).withColumn("l", F.when(F.col("o_orderkey") % 2 == 0, F.slice("l", 1, 1)).otherwise(F.col("l")))
    target = T.StructType.fromDDL("o_orderkey bigint, s struct<status:string,cust:bigint>, l array<bigint>")
    aligned, rejects = lw.align_schema(made, target)
    both = aligned.withColumn("fits", F.lit(True)).unionByName(
        rejects.withColumn("fits", F.lit(False)), allowMissingColumns=True
    )
    return both.select("o_orderkey", "s.status", "s.cust", F.get("l", F.lit(0)).alias("first"), "fits")


ALIGN_NESTED = """
SELECT o_orderkey, o_orderstatus AS status, o_custkey AS cust, o_orderkey AS first,
       o_orderkey % 2 = 0 AS fits FROM orders"""


def align_narrowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers that would lose their fraction are reported, not cut."""
    parts = table(spark, sf_dir, "part")
    target = T.StructType.fromDDL("p_partkey bigint, p_retailprice bigint")
    aligned, rejects = lw.align_schema(parts.select("p_partkey", "p_retailprice"), target)
    fits = aligned.select("p_partkey", F.lit(True).alias("fits"))
    return fits.unionByName(rejects.select("p_partkey", F.lit(False).alias("fits")))


ALIGN_NARROWING = "SELECT p_partkey, p_retailprice = floor(p_retailprice) AS fits FROM part"


def insert_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ignore`` leaves a table alone and reports no row; ``error`` refuses it."""
    loads = _Loads(spark, "insert_modes")
    region = table(spark, sf_dir, "region")
    first = loads.load(region, "one", table_mode="error")
    second = loads.load(region, "two", table_mode="ignore")
    try:
        loads.load(region, "three", table_mode="errorifexists")
        refused = False
    except ValueError:
        refused = True
    told = {"first": F.lit(first.rows_out), "second": F.lit(second.rows_out), "refused": F.lit(refused)}
    return loads.result(*region.columns).withColumns(told)


INSERT_MODES = """
SELECT *, CAST((SELECT count(*) FROM region) AS INTEGER) AS first, 0 AS second, true AS refused
FROM region"""


def empty_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty batch changes nothing, though its mode would overwrite the table."""
    loads = _Loads(spark, "empty_gate")
    nation = table(spark, sf_dir, "nation")
    loads.load(nation, "one")
    result = loads.load(nation.where("n_nationkey < 0"), "two", table_mode="overwrite")
    return loads.result(*nation.columns).withColumn("operation", F.lit(result.operation))


EMPTY_GATE = "SELECT *, 'none' AS operation FROM nation"


def format_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A format that has no code of its own goes by its name."""
    root = workspace(spark, "format_by_name")
    names = table(spark, sf_dir, "part").select(F.to_json(F.struct("*")).alias("value"))
    lw.write_path(names, f"{root}/parts", fmt="text")
    back = lw.read_path(spark, f"{root}/parts", fmt="text")
    return back.select(F.get_json_object("value", "$.p_partkey").cast("long").alias("p_partkey"), F.get_json_object("value", "$.p_name").alias("p_name"))


FORMAT_BY_NAME = "SELECT p_partkey, p_name FROM part"


def preview_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row that Spark comes across is one of the table's; the report is on all of them."""
    nation = table(spark, sf_dir, "nation")
    one = lw.preview(nation)
    found = nation.join(one, nation.columns, "left_semi").agg(F.count("*").alias("found"))
    return nation.withColumn("found", F.lit(found.first()["found"]).cast("long"))


PREVIEW_ROW = "SELECT *, CAST(1 AS BIGINT) AS found FROM nation"


def plain_tree_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in month/day/hour folders without column names, as a batch and as a stream."""
    root = workspace(spark, "plain_tree")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string"))
    for hour in range(4):
        part = events.where(F.hour(F.col("ts").cast("timestamp_ntz")) % 4 == hour)
        lw.write_path(part, f"{root}/in/1/2/{hour}", fmt="csv", options={"escape": '"'})
    how = {"schema": events.schema, "recursive": True, "options": {"escape": '"'}}
    batch = lw.read_path(spark, f"{root}/in", "csv", **how)
    stream = lw.file_stream(spark, f"{root}/in", "csv", **how)
    lw.append_stream(stream, f"{root}/out", f"{root}/checkpoint")
    streamed = spark.read.schema(events.schema).parquet(f"{root}/out")
    both = batch.withColumn("side", F.lit("batch")).unionByName(streamed.withColumn("side", F.lit("stream")))
    return both.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


PLAIN_TREE_SCAN = """
SELECT *, 'batch' AS side FROM events UNION ALL SELECT *, 'stream' FROM events"""


def stream_nested_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A struct that gains a field between two runs of a stream."""
    root = workspace(spark, "stream_nested_growth")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    half = orders.where("o_orderkey % 2 = 0").select("o_orderkey", F.struct("o_custkey").alias("s"))
    rest = orders.where("o_orderkey % 2 = 1").select("o_orderkey", F.struct("o_custkey", "o_orderstatus").alias("s"))
    spec = lw.StreamSpec(source=f"{root}/in", fmt="json", path=f"{root}/out", checkpoint=f"{root}/checkpoint", schema_path=f"{root}/schema")
    for day, df in (("one", half), ("two", rest)):
        lw.write_path(df, f"{root}/in/{day}", fmt="json")
        lw.ingest_stream(spark, spec)
    schema = lw.load_schema(spark, f"{root}/schema")
    return spark.read.schema(schema).parquet(f"{root}/out").select("o_orderkey", "s.o_custkey", "s.o_orderstatus")


STREAM_NESTED_GROWTH = """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS o_orderstatus
FROM orders"""


ENTRIES = {
    "job_source_company_code": (job_source_company_code, JOB_SOURCE_COMPANY_CODE),
    "job_soft_flag": (job_soft_flag, JOB_SOFT_FLAG),
    "job_misfits": (job_misfits, JOB_MISFITS),
    "job_extra_columns": (job_extra_columns, JOB_EXTRA_COLUMNS),
    "insert_post_sql_repeat": (insert_post_sql_repeat, INSERT_POST_SQL_REPEAT),
    "job_two_tables_one_batch": (job_two_tables_one_batch, JOB_TWO_TABLES_ONE_BATCH),
    "job_repeat_earlier": (job_repeat_earlier, JOB_REPEAT_EARLIER),
    "job_repeat": (job_repeat, JOB_REPEAT),
    "align_nested": (align_nested, ALIGN_NESTED),
    "align_narrowing": (align_narrowing, ALIGN_NARROWING),
    "insert_modes": (insert_modes, INSERT_MODES),
    "empty_gate": (empty_gate, EMPTY_GATE),
    "format_by_name": (format_by_name, FORMAT_BY_NAME),
    "preview_row": (preview_row, PREVIEW_ROW),
    "plain_tree_scan": (plain_tree_scan, PLAIN_TREE_SCAN),
    "stream_nested_growth": (stream_nested_growth, STREAM_NESTED_GROWTH),
}
