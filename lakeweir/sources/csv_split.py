"""CSV whose records span lines, read by many tasks a file.

A reader that meets a line in the middle of a file cannot tell whether the line
begins inside a quoted value, so Spark gives a multi-line file to one task. Here
files are read by lines, split as plain text is, and the question is settled
afterwards:

1. Every line maps the state it begins in (outside or inside quotes) to the
   state it ends in. Most keep it; an odd number of quotes swaps it; some end in
   one state whatever they began in. The lines of a block, a bounded number of
   neighbouring lines of one split, compose to a map of its own.
2. A prefix over the blocks of a file, a row each, composes these maps: the
   state at the beginning of every block, the records that begin in it, and the
   block in which a record that reaches over the border has begun.
3. Inside a block, a record is a line that begins outside and those after it
   that begin inside. Pieces at borders, two a block at most, are joined to the
   record they belong to.

Lines are shuffled once, by block, to twice as many tasks as scan them; the first two
steps read them another time and move only what a line does to the state.
Windows hold a block at a time. Records are then parsed by Spark.
All of it is built-in expressions.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lakeweir.functions.columns import blank_to_none

QUOTE, ESCAPE, SEP = '"', "\\", ","  # fixed values: Spark's defaults

#: Options under which records are not what quotes and line feeds make of them.
WHOLE_FILE_OPTIONS = ("comment", "linesep", "encoding", "charset", "mode")

#: Lines of a split that one block holds at most.
BLOCK_LINES = 1 << 13

#: Options that choose among files.
LISTING_OPTIONS = ("pathglobfilter", "modifiedbefore", "modifiedafter")


def can_split(options: Mapping[str, str] | None) -> bool:
    """Whether files read with these options can be taken apart by lines."""
    given = {k.lower(): str(v) for k, v in (options or {}).items()}
    named = [k for k in WHOLE_FILE_OPTIONS if given.get(k, "")]
    permissive = given.get("mode", "permissive").lower() == "permissive"
    utf8 = given.get("encoding", given.get("charset", "utf-8")).lower() in ("utf-8", "utf8")
    return (
        all(k == "mode" and permissive or k in ("encoding", "charset") and utf8 for k in named)
        and len(given.get("quote", QUOTE)) == 1
        and len(given.get("escape", ESCAPE)) <= 1
    )


def _state_map(line: Column, quote: str, escape: str, sep: str, trims: bool) -> tuple[Column, Column]:
    """The states that a line ends in: from outside, and from inside quotes."""
    segments = F.split(line, re.escape(quote))
    # Every segment but the last is followed by a quote.
    before_quote = F.slice(segments, 1, F.size(segments) - 1)

    def after(inside: Column, segment: Column, first: Column) -> Column:
        if escape == quote or not escape:
            escaped = F.lit(False)
        else:
            escaped = (F.length(segment) - F.length(F.rtrim(segment, F.lit(escape)))) % 2 == 1
        begun = F.rtrim(segment) if trims else segment
        opens = begun.endswith(sep) | (first & (begun == ""))
        if escape == quote:
            # Two quotes are one of the value: closed and opened again.
            opens = opens | (~first & (segment == ""))
        return F.when(inside, escaped).otherwise(opens)

    def step(state: Column, segment: Column) -> Column:
        first = state["first"]
        return F.struct(
            after(state["outside"], segment, first).alias("outside"),
            after(state["inside"], segment, first).alias("inside"),
            F.lit(False).alias("first"),
        )

    start = F.struct(
        F.lit(False).alias("outside"), F.lit(True).alias("inside"), F.lit(True).alias("first")
    )
    ends = F.aggregate(before_quote, start, step)
    has_quote = F.instr(line, quote) > 0
    return (
        F.when(has_quote, ends["outside"]).otherwise(F.lit(False)),
        F.when(has_quote, ends["inside"]).otherwise(F.lit(True)),
    )


def _composed(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Compose the maps ``(outside, inside)`` of the rows before each row, by key in the order given.

    Adds ``fixed``, whether those rows end in one state whatever they began in,
    and ``odd``: that state, or else whether they swap it.
    """
    ordered = Window.partitionBy(*keys).orderBy(order)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    swaps = (F.col("outside") & ~F.col("inside")).cast("int")
    df = df.withColumn("swaps", F.coalesce(F.sum(swaps).over(before), F.lit(0)))
    settled = F.when(
        F.col("outside") == F.col("inside"),
        F.struct(F.col("outside").alias("state"), F.col("swaps").alias("swaps")),
    )
    df = df.withColumn("settled", F.last(settled, ignorenulls=True).over(before))
    since = F.col("swaps") - F.coalesce(F.col("settled.swaps"), F.lit(0))
    odd = F.coalesce(F.col("settled.state"), F.lit(False)) != (since % 2 == 1)
    return df.withColumns({"fixed": F.col("settled").isNotNull(), "odd": odd}).drop(
        "swaps", "settled"
    )


def _split_states(lines: DataFrame) -> DataFrame:
    """A row for each block of a file: the state it begins in, and its records.

    ``entry`` and ``next_entry`` tell whether it and the next one begin inside quotes,
    ``starts`` counts the records that begin in it, and ``owner`` names the block and
    the number of the last record that began before it. ``crlf`` tells whether the
    first line of the file ends with a carriage return, as all records then do.
    """
    composed = _composed(lines.select("file", "block", "at", "outside", "inside", "cr", "blank"), ["file", "block"], "at")
    # The map of all lines up to and with the last one.
    through = lambda state: F.when(state, F.col("inside")).otherwise(F.col("outside"))
    ends = F.struct(
        through(F.col("odd")).alias("outside"),
        through(F.when(F.col("fixed"), F.col("odd")).otherwise(~F.col("odd"))).alias("inside"),
    )
    splits = composed.groupBy("file", "block").agg(
        F.max_by(ends, "at").alias("ends"),
        F.min_by("cr", "at").alias("cr"),
        F.count_if(~F.col("blank") & F.col("fixed") & ~F.col("odd")).alias("always"),
        F.count_if(~F.col("blank") & ~F.col("fixed") & ~F.col("odd")).alias("if_outside"),
        F.count_if(~F.col("blank") & ~F.col("fixed") & F.col("odd")).alias("if_inside"),
    )
    splits = splits.withColumns({"outside": F.col("ends.outside"), "inside": F.col("ends.inside")})
    # A file begins outside quotes, so what the blocks before make of that is the state.
    splits = _composed(splits, ["file"], "block").withColumn("entry", F.col("odd"))
    starts = F.col("always") + F.when(F.col("entry"), F.col("if_inside")).otherwise(
        F.col("if_outside")
    )
    in_file = Window.partitionBy("file").orderBy("block")
    begun = F.when(
        F.col("starts") > 0,
        F.struct(F.col("block").alias("block"), F.col("starts").alias("record")),
    )
    return splits.withColumn("starts", starts).select(
        "file",
        "block",
        "entry",
        "starts",
        F.coalesce(F.lead("entry").over(in_file), F.lit(False)).alias("next_entry"),
        F.first("cr").over(in_file).alias("crlf"),
        F.last(begun, ignorenulls=True)
        .over(in_file.rowsBetween(Window.unboundedPreceding, -1))
        .alias("owner"),
    )


def multiline_records(
    spark: SparkSession,
    path: str,
    *,
    quote: str = QUOTE,
    escape: str = ESCAPE,
    sep: str = SEP,
    trims: bool = False,
    recursive: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """``(file, first, text)``: the records of CSV files as text, line breaks in quotes included.

    ``first`` marks the first record of a file. Records end with a line feed, or
    with a carriage return and one where the file's first line does; the latter
    are read as line feeds in values too. Empty lines between records
    are no records. Quotes inside a value that does not begin with one are
    plain characters. A value that is never closed goes to the end of the file, without
    its last line feed.
    """
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", recursive)
    listing = {k: v for k, v in (options or {}).items() if k.lower() in LISTING_OPTIONS}
    lines = reader.options(**listing).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    n_scans = max(1, lines.rdd.getNumPartitions())
    # Both passes scan alike, so a line has the same number in its task, and the same block.
    in_task = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    block = F.struct("split", F.floor(in_task / BLOCK_LINES).alias("part"))
    lines = lines.select("file", block.alias("block"), "at", "value")
    outside, inside = _state_map(F.col("value"), quote, escape, sep, trims)
    lines = lines.withColumns(
        {
            "outside": outside,
            "inside": inside,
            "cr": F.col("value").endswith("\r"),
            "blank": F.col("value").isin("", "\r"),
        }
    )
    splits = _split_states(lines)

    lines = lines.repartition(2 * n_scans, "file", "block")
    lines = _composed(lines, ["file", "block"], "at").join(splits, ["file", "block"])
    within = F.when(F.col("fixed"), F.col("odd")).otherwise(F.col("odd") != F.col("entry"))
    # An empty line between records is none; one inside quotes is part of the value.
    lines = lines.withColumn("starts_record", ~within).where("NOT (starts_record AND blank)")
    in_block = Window.partitionBy("file", "block").orderBy("at")
    lines = lines.withColumns(
        {
            "record": F.sum(F.col("starts_record").cast("long")).over(
                in_block.rowsBetween(Window.unboundedPreceding, 0)
            ),
            "ends_record": F.coalesce(F.lead("starts_record").over(in_block), ~F.col("next_entry")),
        }
    )
    # The first record of a file is the first of a block that no record has begun before.
    lines = lines.withColumn("first", F.col("owner").isNull() & (F.col("record") == 1))
    whole = lines.where("starts_record AND ends_record").select(
        "file", "block", "record", "first", "crlf", F.col("value").alias("text")
    )
    parts = lines.where("NOT (starts_record AND ends_record)")
    parts = parts.groupBy("file", "block", "record").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]),
            "\n",
        ).alias("text"),
        F.first("owner").alias("owner"),
        F.first("crlf").alias("crlf"),
        F.first("first").alias("first"),
        (F.first("next_entry") & (F.first("starts") == F.col("record"))).alias("goes_on"),
    )
    # The first piece of a record that goes on, and pieces that go on from an earlier block.
    border = parts.where("goes_on OR record = 0")
    inner = parts.where("NOT (goes_on OR record = 0)").select(*whole.columns)
    own = F.struct(F.col("block").alias("block"), F.col("record").alias("record"))
    border = border.withColumn("owner", F.when(F.col("record") > 0, own).otherwise(F.col("owner")))
    joined = border.groupBy("file", "owner").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda x: x["text"]),
            "\n",
        ).alias("text"),
        F.first("crlf").alias("crlf"),
        F.bool_or("first").alias("first"),
    )
    joined = joined.select(
        "file",
        F.col("owner.block").alias("block"),
        F.col("owner.record").alias("record"),
        "first",
        "crlf",
        "text",
    )
    records = whole.unionByName(inner).unionByName(joined)
    # Where records end with a carriage return, line breaks are read as line feeds.
    unix = F.regexp_replace(F.regexp_replace("text", "\r\n", "\n"), "\r$", "")
    records = records.withColumn("text", F.when(F.col("crlf"), unix).otherwise(F.col("text")))
    return records.select("file", "first", "text")


def read_multiline_csv(
    spark: SparkSession,
    path: str,
    *,
    sep: str | None = None,
    header: bool = True,
    schema: T.StructType | str | None = None,
    recursive: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows of multi-line CSV files, each file read by as many tasks as it has splits.

    The rows are those of Spark's own reader with ``multiLine``. Without a
    schema, types are inferred in a further pass, names come from the header,
    and a file whose header names other columns is refused.
    """
    options = dict(options or {})
    if not can_split(options):
        raise ValueError(f"none of {WHOLE_FILE_OPTIONS} can be set for files that are split")
    given = {k.lower(): v for k, v in options.items()}
    sep = blank_to_none(sep) or given.get("sep") or given.get("delimiter") or SEP
    records = multiline_records(
        spark,
        path,
        quote=given.get("quote", QUOTE),
        escape=given.get("escape", ESCAPE),
        sep=sep,
        trims=str(given.get("ignoreleadingwhitespace", "false")).lower() == "true",
        recursive=recursive,
        options=options,
    )
    parsing = {k: v for k, v in options.items() if k.lower() not in ("inferschema", "header", "enforceschema", "delimiter")}
    parsing |= {"sep": sep, "multiLine": "true", "header": "false"}
    data = records.where(~F.col("first")) if header else records
    if schema is None:
        names = None
        if header:
            heads = [row["text"] for row in records.where("first").select("text").distinct().limit(100).collect()]
            found = {tuple(_fields(spark, head, parsing)) for head in heads}
            if len({tuple(name.lower() for name in names) for names in found}) > 1:
                raise ValueError(f"files under {path} have headers that name different columns: {sorted(found)[:2]}")
            names = min(found) if found else ()
        kinds = _inferred(data.select("text"), parsing)
        if names is None:
            schema = kinds
        else:
            kept = [f.dataType for f in kinds.fields] + [T.StringType()] * len(names)
            schema = T.StructType([T.StructField(n, t) for n, t in zip(names, kept)])
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if not schema.fields:
        return spark.createDataFrame([], schema)
    row = F.from_csv("text", schema_ddl(schema), parsing).alias("row")
    return data.select(row).select(
        *[F.col("row").getField(f.name).alias(f.name) for f in schema.fields]
    )


def schema_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def _fields(spark: SparkSession, record: str, parsing: Mapping[str, str]) -> list[str]:
    """The values of one record, such as a header; those without a name get Spark's ``_c<n>``."""
    shape = spark.range(1).select(F.schema_of_csv(F.lit(record), dict(parsing))).first()[0]
    n = len(T.StructType.fromDDL(shape.removeprefix("STRUCT<").removesuffix(">")).fields)
    schema = ", ".join(f"c{i} string" for i in range(n))
    values = spark.range(1).select(F.from_csv(F.lit(record), schema, dict(parsing)).alias("r")).select("r.*").first()
    return [value or f"_c{i}" for i, value in enumerate(values)]


def _inferred(records: DataFrame, parsing: Mapping[str, str]) -> T.StructType:
    """Types of records that are at hand as text, found by Spark's own reader."""
    spark = records.sparkSession
    texts = getattr(records._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    reader = spark.read.options(**parsing).option("inferSchema", True)
    return DataFrame(reader._jreader.csv(texts), spark).schema
