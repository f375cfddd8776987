import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import crossfeed  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[4]").appName("crossfeed-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.driver.memory", "4g")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .getOrCreate())
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def derby(spark):
    folder = tempfile.mkdtemp(prefix="crossfeed-test-")
    system = spark._jvm.java.lang.System
    system.setProperty("derby.stream.error.file", f"{folder}/derby.log")
    system.setProperty("derby.system.durability", "test")
    crossfeed.register_connection("derby", f"jdbc:derby:{folder}/db;create=true")
    return "derby"


@pytest.fixture(scope="session")
def lite(spark):
    folder = tempfile.mkdtemp(prefix="crossfeed-test-")
    crossfeed.register_connection("lite", f"dbapi:sqlite3:{folder}/db.sqlite")
    return "lite"


@pytest.fixture(params=["derby", "lite"])
def external(request):
    """The name of a connection, once over JDBC and once over DB-API."""
    return request.getfixturevalue(request.param)
