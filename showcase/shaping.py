"""De-duplication, names, alignment, flattening, audit columns, bounds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import lakeweir as lw
from showcase.common import table


def dedupe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return lw.drop_duplicate_rows(documents.unionAll(documents))


DEDUPE_ROWS = "SELECT DISTINCT * FROM (SELECT * FROM documents UNION ALL SELECT * FROM documents)"


def dedupe_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("role", "text")
    return lw.drop_duplicate_rows(turns, copies="copies")


DEDUPE_COPIES = "SELECT role, text, count(*) AS copies FROM conversations GROUP BY role, text"


def dedupe_map_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a map column, whose entries come in different orders."""
    lines = table(spark, sf_dir, "lineitem")
    one_way = F.create_map(F.lit("flag"), "l_returnflag", F.lit("status"), "l_linestatus")
    other_way = F.create_map(F.lit("status"), "l_linestatus", F.lit("flag"), "l_returnflag")
    rows = lines.select(
        "l_linenumber", F.when(F.col("l_tax") > 0.04, one_way).otherwise(other_way).alias("m")
    )
    return lw.drop_duplicate_rows(rows).select(
        "l_linenumber", F.col("m")["flag"].alias("flag"), F.col("m")["status"].alias("status")
    )


DEDUPE_MAP_ROWS = """
SELECT DISTINCT l_linenumber, l_returnflag AS flag, l_linestatus AS status FROM lineitem"""


def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lw.latest_per_key(table(spark, sf_dir, "events"), "user_id|event_type", "ts")


LATEST_PER_KEY = """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type
            ORDER BY ts DESC, event_id DESC) AS place FROM events)
WHERE place = 1"""


def strip_column_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    spaced = table(spark, sf_dir, "customer").toDF(
        "cust key", "full name", " nation", "acct bal ", "mkt segment"
    )
    return lw.strip_column_spaces(spaced)


STRIP_COLUMN_SPACES = """
SELECT c_custkey AS custkey, c_name AS fullname, c_nationkey AS nation, c_acctbal AS acctbal,
       c_mktsegment AS mktsegment FROM customer"""


# Other order, wider types, one column less, one that the batch lacks.
ALIGNED_ORDERS = T.StructType(
    [
        T.StructField("O_ORDERDATE", T.DateType()),
        T.StructField("o_totalprice", T.DecimalType(12, 2)),
        T.StructField("o_orderkey", T.StringType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_clerk", T.StringType()),
    ]
)


def align_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned, _ = lw.align_schema(table(spark, sf_dir, "orders"), ALIGNED_ORDERS)
    return aligned


ALIGN_SCHEMA = """
SELECT CAST(o_orderdate AS DATE) AS "O_ORDERDATE",
       CAST(o_totalprice AS DECIMAL(12, 2)) AS o_totalprice,
       CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_custkey, o_orderstatus,
       CAST(NULL AS VARCHAR) AS o_clerk FROM orders"""


SIZED_PARTS = T.StructType(
    [
        T.StructField("p_partkey", T.LongType()),
        T.StructField("p_size", T.IntegerType()),
        T.StructField("p_retailprice", T.DoubleType()),
    ]
)


def messy_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes as text, not all of it numbers."""
    size = F.when(F.col("p_type") == "SMALL", F.concat(F.lit("about "), "p_size")).otherwise(
        F.col("p_size").cast("string")
    )
    return table(spark, sf_dir, "part").select("p_partkey", size.alias("p_size"), "p_retailprice")


def align_accepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned, _ = lw.align_schema(messy_parts(spark, sf_dir), SIZED_PARTS)
    return aligned


ALIGN_ACCEPTS = "SELECT p_partkey, p_size, p_retailprice FROM part WHERE p_type <> 'SMALL'"


def align_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = lw.align_schema(messy_parts(spark, sf_dir), SIZED_PARTS)
    return rejects.select("p_partkey", "p_retailprice", F.inline("rejected_values"))


ALIGN_REJECTS = """
SELECT p_partkey, p_retailprice, 'p_size' AS "column", 'about ' || p_size AS value
FROM part WHERE p_type = 'SMALL'"""


def flatten_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return lw.flatten(lw.parse_json_column(events, "props", "k BIGINT"))


FLATTEN_JSON = """
SELECT event_id, ts, user_id, event_type, value,
       CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events"""


def flatten_unknown_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties with a field that some rows lack and one of two types; nobody gives the schema."""
    events = table(spark, sf_dir, "events")
    more = F.when(
        F.col("event_id") % 2 == 0,
        F.format_string(', "at": {"user": %d}, "kind": "%s"}', "user_id", "event_type"),
    ).otherwise(F.format_string(', "kind": %d}', "event_id"))
    props = F.concat(F.expr("left(props, char_length(props) - 1)"), more).alias("props")
    return lw.flatten(lw.open_json(events.select("event_id", props), "props"))


FLATTEN_UNKNOWN_JSON = """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN user_id END AS props_at_user,
       CAST(json_extract(props, '$.k') AS BIGINT) AS props_k,
       CASE WHEN event_id % 2 = 0 THEN event_type ELSE CAST(event_id AS VARCHAR) END AS props_kind,
       CAST(NULL AS VARCHAR) AS props_rest FROM events"""


def flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structs in structs and an array of structs; some arrays are null."""
    documents = table(spark, sf_dir, "documents")
    lines = F.transform(F.split("text", "\n"), lambda line: F.struct(line.alias("text")))
    nested = documents.select(
        "doc_id",
        F.struct(
            "lang", F.struct(F.col("source").alias("name"), "n_chars").alias("origin")
        ).alias("meta"),
        F.when(F.col("lang") != "fr", lines).alias("line"),
    )
    return lw.flatten(nested)


FLATTEN_NESTED = """
SELECT doc_id, lang AS meta_lang, source AS meta_origin_name, n_chars AS meta_origin_n_chars,
       unnest(string_split(text, chr(10))) AS line_text
FROM documents WHERE lang <> 'fr'
UNION ALL
SELECT doc_id, lang, source, n_chars, NULL FROM documents WHERE lang = 'fr' OR lang IS NULL"""


def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    audited = lw.add_audit(
        table(spark, sf_dir, "supplier"),
        "417",
        "raw/acme/supplier.csv",
        load_time=dt.datetime(2024, 2, 3, 4, 5, 6, tzinfo=dt.timezone.utc),
        tenant="acme",
    )
    in_utc = F.to_utc_timestamp("ELT_Timestamp", F.current_timezone())
    return audited.withColumn("ELT_Timestamp", in_utc.cast("timestamp_ntz"))


AUDIT_COLUMNS = """
SELECT *, 'ACME' AS company_code, CAST(417 AS INTEGER) AS "ELT_TransformInstanceID",
       'raw/acme/supplier.csv' AS "ELT_SourceFile",
       TIMESTAMP '2024-02-03 04:05:06' AS "ELT_Timestamp" FROM supplier"""


def string_bound_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lw.string_bound_report(table(spark, sf_dir, "documents"))


STRING_BOUND_REPORT = """
SELECT 'text' AS column_name, count(*) FILTER (WHERE length(text) > 4000) AS rows_over,
       CAST(max(length(text)) AS INTEGER) AS longest FROM documents
UNION ALL
SELECT 'lang', count(*) FILTER (WHERE length(lang) > 4000),
       CAST(max(length(lang)) AS INTEGER) FROM documents
UNION ALL
SELECT 'source', count(*) FILTER (WHERE length(source) > 4000),
       CAST(max(length(source)) AS INTEGER) FROM documents"""


def overlong_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lw.overlong_rows(table(spark, sf_dir, "documents"))


OVERLONG_ROWS = "SELECT * FROM documents WHERE length(text) > 4000"


ENTRIES = {
    "dedupe_rows": (dedupe_rows, DEDUPE_ROWS),
    "dedupe_copies": (dedupe_copies, DEDUPE_COPIES),
    "dedupe_map_rows": (dedupe_map_rows, DEDUPE_MAP_ROWS),
    "latest_per_key": (latest_per_key, LATEST_PER_KEY),
    "strip_column_spaces": (strip_column_spaces, STRIP_COLUMN_SPACES),
    "align_schema": (align_schema, ALIGN_SCHEMA),
    "align_accepts": (align_accepts, ALIGN_ACCEPTS),
    "align_rejects": (align_rejects, ALIGN_REJECTS),
    "flatten_json": (flatten_json, FLATTEN_JSON),
    "flatten_unknown_json": (flatten_unknown_json, FLATTEN_UNKNOWN_JSON),
    "flatten_nested": (flatten_nested, FLATTEN_NESTED),
    "audit_columns": (audit_columns, AUDIT_COLUMNS),
    "string_bound_report": (string_bound_report, STRING_BOUND_REPORT),
    "overlong_rows": (overlong_rows, OVERLONG_ROWS),
}
