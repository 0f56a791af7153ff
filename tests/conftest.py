import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "checkpoints"))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_option(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield set_option
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def schema(spark, tmp_path):
    """A catalog schema of its own for one test."""
    name = "s_" + tmp_path.name.replace("-", "_").replace("[", "_").replace("]", "_")
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{tmp_path}/schema'")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")
