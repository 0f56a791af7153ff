"""Multi-line CSV read by splits, against Spark's reader of whole files."""

import random

import pytest
from pyspark.sql import functions as F

import lakeweir as lw
from lakeweir.sources.csv_split import can_split
from showcase import files
from tests.helpers import rows


@pytest.fixture
def small_splits(conf):
    conf("spark.sql.files.maxPartitionBytes", "700b")
    conf("spark.sql.files.openCostInBytes", "1b")


def write(tmp_path, text, name="in.csv"):
    path = tmp_path / name
    path.write_bytes(text.encode())
    return str(path)


def whole(spark, path, header=True, schema=None, **options):
    reader = spark.read.option("header", header).option("multiLine", True).options(**options)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def scan_tasks(spark, path):
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.spark_partition_id()).distinct().count()


def random_file(seed, escape, end, sep=","):
    rng = random.Random(seed)

    def value():
        kind = rng.randint(0, 7)
        if kind < 4:
            return ["", 'ab 5" z', '""', str(rng.randint(0, 99))][kind]
        letters = ["a", "b", sep, end, "Q", "E", " ", "é"]
        n = rng.randint(0, 3000 if rng.random() < 0.02 else 30)
        text = "".join(rng.choice(letters) for _ in range(n))
        text = text.replace("E", "\\\\" if escape == "\\" else "\\").replace("Q", escape + '"')
        return f'"{text}"'

    lines = [f"id{sep}a b{sep}c"]
    for i in range(300):
        lines.append(f"{i}{sep}{value()}{sep}{value()}" + (end if rng.random() < 0.1 else ""))
    return end.join(lines) + end


@pytest.mark.parametrize("escape", ["\\", '"'])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_same_rows_as_the_whole_file(spark, tmp_path, small_splits, escape, end):
    path = write(tmp_path, random_file(f"{escape}{end}", escape, end))
    assert scan_tasks(spark, path) > 10
    ours = lw.read_multiline_csv(spark, path, options={"escape": escape})
    theirs = whole(spark, path, escape=escape)
    assert ours.schema == theirs.schema
    assert rows(ours) == rows(theirs)


def test_a_record_over_many_splits_and_quotes_at_their_borders(spark, tmp_path, small_splits):
    long = "\n".join(f'line {i} ""quoted"", with more' for i in range(400))
    text = "".join(f'{i},"{"x" * k}\n{"" if i % 3 else long}\ny"\n' for i, k in enumerate(range(680, 720)))
    path = write(tmp_path, text)
    schema = "id int, text string"
    ours = lw.read_multiline_csv(spark, path, header=False, schema=schema, options={"escape": '"'})
    assert rows(ours) == rows(whole(spark, path, False, schema, escape='"'))
    assert ours.count() == 40


@pytest.mark.parametrize("lines", [1, 3, 50])
def test_blocks_of_few_lines(spark, tmp_path, monkeypatch, lines):
    monkeypatch.setattr("lakeweir.sources.csv_split.BLOCK_LINES", lines)
    path = write(tmp_path, random_file(lines, '"', "\n"))
    ours = lw.read_multiline_csv(spark, path, schema="id int, b string, c string", options={"escape": '"'})
    assert rows(ours) == rows(whole(spark, path, schema="id int, b string, c string", escape='"'))


def test_lines_move_to_more_tasks_the_more_scan_them(spark, tmp_path, small_splits, conf):
    conf("spark.sql.shuffle.partitions", "2")
    path = write(tmp_path, random_file(7, '"', "\n"))
    n = spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions()
    assert n > 10
    plan = lw.read_multiline_csv(spark, path, schema="id int, b string, c string", options={"escape": '"'})
    assert f", {2 * n}), REPARTITION_BY_NUM" in plan._jdf.queryExecution().toString()


def test_files_are_written_by_many_tasks(spark, tmp_path, monkeypatch, conf):
    conf("spark.sql.files.openCostInBytes", "64m")
    monkeypatch.setattr(files, "workspace", lambda *_: str(tmp_path / "work"))
    texts = [None, "plain", 'a "quoted"\nline, and\n\nmore', "x\n" * 50]
    docs = spark.createDataFrame([(i, texts[i % 4], "en", "b") for i in range(64)], "doc_id long, text string, lang string, source string")
    docs.repartition(8).write.parquet(str(tmp_path / "documents.parquet"))
    read = files.csv_multiline_split(spark, str(tmp_path))
    assert rows(read) == rows(docs)
    assert len(list((tmp_path / "work").rglob("part-*.csv"))) == 4


def test_several_files_separators_and_leading_space(spark, tmp_path, small_splits):
    for i in range(3):
        write(tmp_path, random_file(i, "\\", "\n", ";").replace(';"', '; "'), f"{i}.csv")
    options = {"ignoreLeadingWhiteSpace": "true"}
    ours = lw.read_multiline_csv(spark, str(tmp_path), sep=";", options=options)
    assert rows(ours) == rows(whole(spark, str(tmp_path), sep=";", **options))


def test_headers_that_differ_are_refused(spark, tmp_path):
    write(tmp_path, "a,b\n1,2\n", "1.csv")
    write(tmp_path, "b,a\n1,2\n", "2.csv")
    with pytest.raises(ValueError, match="different columns"):
        lw.read_multiline_csv(spark, str(tmp_path))


@pytest.mark.parametrize("text", ["", "a,b\n", "\n\na,b\n\n1,\"x\ny\"", 'a,b\n1,"never closed\n2,3', "a,b\n\n\n" + "\n" * 900 + "1,2\n"])
def test_odd_files(spark, tmp_path, small_splits, text):
    path = write(tmp_path, text)
    ours = lw.read_multiline_csv(spark, path)
    theirs = whole(spark, path)
    assert ours.columns == theirs.columns
    assert rows(ours) == rows(theirs)


def test_large_files_are_split_by_default(spark, tmp_path, small_splits):
    path = write(tmp_path, random_file(5, "\\", "\n"))
    zones = {"raw": str(tmp_path)}
    read = lw.read_dataset(spark, zones, "raw", "", None, "in.csv", dedupe=False)
    assert "Window" in read._jdf.queryExecution().executedPlan().toString()
    assert rows(read) == rows(whole(spark, path))
    small = write(tmp_path, "a,b\n1,2\n", "small.csv")
    assert "Window" not in lw.read_path(spark, small, multiline=True)._jdf.queryExecution().executedPlan().toString()


def test_what_cannot_be_split(spark, tmp_path):
    assert can_split(None) and can_split({"mode": "PERMISSIVE", "encoding": "UTF-8"})
    for options in ({"comment": "#"}, {"lineSep": "|"}, {"encoding": "latin1"}, {"mode": "DROPMALFORMED"}, {"quote": ""}):
        assert not can_split(options)
    path = write(tmp_path, "a,b\n1,2\n")
    with pytest.raises(ValueError, match="can be set"):
        lw.read_multiline_csv(spark, path, options={"comment": "#"})
    with pytest.raises(ValueError, match="multi-line CSV"):
        lw.read_path(spark, path, split=True)
