"""Shared by all query modules."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lakeweir import create_schema, shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workspace(spark: SparkSession, label: str) -> str:
    """A new folder for one run of a query."""
    return f"{shared_dir(spark)}/showcase/{label}-{uuid.uuid4().hex}"


def scratch_schema(spark: SparkSession, label: str) -> str:
    """A new catalog schema whose tables live in a new folder."""
    name = f"{label}_{uuid.uuid4().hex}"
    create_schema(spark, name, workspace(spark, name))
    return name
