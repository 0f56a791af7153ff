"""What several test modules use."""

import re
from collections import Counter

import lakeweir as lw


def rows(df):
    """The rows of a frame as a multiset, whatever their order."""
    return Counter(tuple(row) for row in df.collect())


def final_plan(df):
    """The physical plan after adaptive execution has run it."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def count_in(plan, pattern):
    return len(re.findall(pattern, plan))


def staged_folders(spark):
    """Names of what is staged in the shared folder at the moment."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{lw.shared_dir(spark)}/lakeweir-stage")
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in fs.listStatus(where)} if fs.exists(where) else set()
