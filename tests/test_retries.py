"""Loads whose tasks fail half-way and are run again, in a session of its own that allows it."""

import os
import subprocess
import sys
import textwrap

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent("""
    import sys, tempfile
    sys.path.insert(0, {root!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession
    import crossfeed as cf

    folder = tempfile.mkdtemp(prefix="crossfeed-test-")
    spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "2g")
             .config("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
             .config("spark.checkpoint.dir", folder + "/shared").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", folder + "/derby.log")
    cf.register_connection("derby", "jdbc:derby:" + folder + "/db;create=true")
    cf.register_connection("lite", "dbapi:sqlite3:" + folder + "/db.sqlite")

    def failing_once(batches):
        for place, batch in enumerate(batches):
            if place == 3 and TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("lost")
            yield batch

    failures = spark.range(0, 2000, 1, 4).mapInPandas(failing_once, "id bigint")
    for name in ("derby", "lite"):
        # With stable input the failing step runs within the write itself.
        result = cf.ext_load(failures, table_name="retried", connection=name, stable_input=True)
        held = cf.ext_scan(spark, table_name="retried", connection=name, partition_column="id", num_partitions=3)
        assert result.rows == 2000, result
        assert sorted(row["id"] for row in held.collect()) == list(range(2000)), name
    print("all rows once")
""")


def test_tasks_that_are_run_again_leave_no_copies(tmp_path):
    pytest.importorskip("pandas")
    script = tmp_path / "retries.py"
    script.write_text(SCRIPT.format(root=ROOT))
    # Another working folder: tasks get the code from the session, not from an import path.
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "all rows once" in done.stdout, done.stdout + done.stderr[-3000:]
