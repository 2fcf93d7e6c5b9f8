import pytest

from storeglass.session import build_session
from storeglass.sources.retail import StarTables

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[4]", "tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.sql.maxMetadataStringLength": "2000",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star(spark):
    return StarTables(spark, ROOT)
