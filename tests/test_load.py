import datetime as dt

import pytest
from pyspark.sql import functions as F

import crossfeed as cf
from crossfeed import connections
from crossfeed.admin import TABLE_KINDS, open_admin
from crossfeed.sinks import load
from crossfeed.sources import dbapi


def table_names(spark, connection):
    with open_admin(spark, connections.resolve(connection)) as admin:
        return {one.name for one in admin.relations(TABLE_KINDS)}


def read(spark, connection, table):
    return sorted(tuple(row) for row in cf.ext_scan(spark, table_name=table, connection=connection).collect())


def test_append_overwrite_and_truncate(spark, external):
    first = spark.createDataFrame([(1, "one"), (2, None)], "id int, word string")
    assert cf.ext_load(first, table_name="modes", connection=external, mode="overwrite").rows == 2
    wider = spark.createDataFrame([(3, "two")], "id int, word string")
    cf.ext_load(wider, table_name="modes", connection=external)
    assert cf.ext_scan(spark, table_name="modes", connection=external).count() == 3
    cf.ext_load(wider, table_name="modes", connection=external, mode="overwrite", truncate=True)
    assert read(spark, external, "modes") == [(3, "two")]
    other = spark.createDataFrame([(4.5,)], "amount double")
    cf.ext_load(other, table_name="modes", connection=external, mode="overwrite")
    assert read(spark, external, "modes") == [(4.5,)]
    with pytest.raises(cf.ExternalError, match="Parameter 'mode'"):
        cf.ext_load(other, table_name="modes", connection=external, mode="merge")
    assert not [name for name in table_names(spark, external) if name.startswith("modes_cf_")]


def test_a_failed_partition_leaves_the_target_alone(spark, external):
    cf.ext_load(spark.range(10), table_name="steady", connection=external, mode="overwrite")
    broken = spark.range(0, 100, 1, 4).select(
        F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).cast("bigint").alias("id"))
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="lost"):
            cf.ext_load(broken, table_name="steady", connection=external, mode=mode, stable_input=True)
        assert cf.ext_scan(spark, table_name="steady", connection=external).count() == 10
    assert not [name for name in table_names(spark, external) if name.startswith("steady_cf_")]


def test_a_failed_last_statement_leaves_the_target_alone(spark, external):
    cf.ext_load(spark.range(10), table_name="steady2", connection=external, mode="overwrite")
    with pytest.raises(cf.ExternalError):
        cf.ext_load(spark.range(3), table_name="steady2", connection=external, mode="overwrite",
                    post_sql=('DELETE FROM "no_such_table"',))
    assert cf.ext_scan(spark, table_name="steady2", connection=external).count() == 10


def test_copies_of_a_repeated_task_are_left_out_over_jdbc(spark, derby, monkeypatch):
    """Half of the partitions are written twice, as by an executor that is lost after its commit."""
    write = load._Plan._write

    def twice(self, frame, path, types=None):
        write(self, frame, path, types)
        if types is None:
            again = frame.filter(F.expr(f"{load.ROW_COLUMN} >> 33") < 2)
            again = again.withColumn(load.TRY_COLUMN, F.java_method(F.lit("java.util.UUID"), F.lit("randomUUID")))
            write(self, again, path, types)

    monkeypatch.setattr(load._Plan, "_write", twice)
    frame = spark.range(0, 100, 1, 4).selectExpr("id", "repeat('x', 40000) AS long_text", "id % 3 AS k")
    result = cf.ext_load(frame, table_name="repeated", connection=derby, mode="overwrite")
    assert result.rows == 100
    back = cf.ext_scan(spark, table_name="repeated", connection=derby)
    assert sorted(row["id"] for row in back.select("id").collect()) == list(range(100))


def test_a_task_that_ends_late_is_left_out_too(spark, derby, monkeypatch):
    """Its rows arrive after the counting, within the time of the move."""
    from crossfeed.admin import _JdbcAdmin
    update, late = _JdbcAdmin.update, []

    def disturbed(self, sql):
        if sql.startswith("INSERT INTO") and not late:
            late.append(sql)
            place = sql.split(" FROM ")[1].split(" ")[0]
            with open_admin(spark, connections.resolve(derby, read_only=False)) as other:
                columns = f'"id", "{load.ROW_COLUMN}"'
                other.run(f'INSERT INTO {place} ({columns}, "{load.TRY_COLUMN}") '
                          f"SELECT {columns}, 'zz' FROM {place} WHERE \"id\" < 5")
        return update(self, sql)

    monkeypatch.setattr(_JdbcAdmin, "update", disturbed)
    result = cf.ext_load(spark.range(0, 40, 1, 4), table_name="late", connection=derby, mode="overwrite")
    assert late and result.rows == 40
    assert sorted(row[0] for row in read(spark, derby, "late")) == list(range(40))


def test_rows_that_got_lost_are_noticed(spark, derby, monkeypatch):
    write = load._Plan._write

    def partly(self, frame, path, types=None):
        write(self, frame, path, types)
        if types is None:
            with open_admin(spark, self.found) as admin:
                admin.run(f'DELETE FROM {path} WHERE "id" = 7')

    monkeypatch.setattr(load._Plan, "_write", partly)
    with pytest.raises(cf.ExternalError, match="10 rows were written, 9 arrived"):
        cf.ext_load(spark.range(10), table_name="shrunk", connection=derby, mode="overwrite")
    assert "shrunk" not in table_names(spark, derby)


def test_attempts_that_spark_did_not_accept_are_left_out_over_dbapi(spark, lite, tmp_path):
    options = {"module": "sqlite3", "database": str(tmp_path / "a.db"), "staging": '"s"', "target": '"t"',
               "before": '["CREATE TABLE \\"t\\" (\\"id\\" BIGINT)"]', "after": "[]"}
    with dbapi.Session(options, read_only=False) as session:
        session.run(f'CREATE TABLE "s" ("id" BIGINT, {dbapi.TAG_COLUMN} VARCHAR(32))')
    import pyarrow as pa
    writer = dbapi.DbApiWriter(options, spark.range(1).schema)
    batch = pa.RecordBatch.from_pydict({"id": [1, 2, 3]})
    writer.write(iter([batch]))
    accepted = writer.write(iter([batch, batch.slice(0, 1)]))
    writer.commit([accepted, None])
    with dbapi.Session(options, read_only=True) as session:
        assert sorted(session.cursor('SELECT "id" FROM "t"').fetchall()) == [(1,), (1,), (2,), (3,)]
        assert session.cursor("SELECT count(*) FROM sqlite_master WHERE name <> 't'").fetchone() == (0,)


def test_null_sentries_and_flags(spark, external):
    frame = spark.createDataFrame([(1, "x", 0, True), (2, "none", 5, False), (3, None, -1, None)],
                                  "id int, word string, n int, hide boolean")
    cf.ext_load(frame, table_name="nulled", connection=external, mode="overwrite",
                null_sentries={"word": "none", "n": -1}, null_flags={"n": "hide"})
    back = cf.ext_scan(spark, table_name="nulled", connection=external).orderBy("id")
    assert back.columns == ["id", "word", "n"]
    assert [tuple(row) for row in back.collect()] == [(1, "x", None), (2, None, 5), (3, None, None)]
    never = dt.datetime(9999, 12, 31, 23, 59, 59)
    times = spark.createDataFrame([(1, never, never.date()), (2, dt.datetime(2024, 1, 1), dt.date(2024, 1, 1))],
                                  "id int, ts timestamp_ntz, day date")
    cf.ext_load(times, table_name="endless", connection=external, mode="overwrite",
                null_sentries={"ts": never, "day": never.date()})
    assert read(spark, external, "endless")[0] == (1, None, None)
    with pytest.raises(cf.ExternalError, match="Column 'absent'"):
        cf.ext_load(frame, table_name="nulled", connection=external, null_sentries={"absent": 1})


def test_text_columns_get_the_width_of_their_longest_value(spark, derby):
    frame = spark.createDataFrame([("ab", None), ("abcdé", None)], "word string, empty string")
    cf.ext_load(frame, table_name="widths", connection=derby, mode="overwrite")
    with open_admin(spark, connections.resolve(derby)) as admin:
        assert admin.text_widths("widths") == {"word": 5, "empty": 1}
    too_long = spark.createDataFrame([("abcdef", "")], "word string, empty string")
    with pytest.raises(cf.ExternalError):
        cf.ext_load(too_long, table_name="widths", connection=derby)
    assert cf.ext_scan(spark, table_name="widths", connection=derby).count() == 2


def test_straight_load(spark, derby):
    result = cf.ext_load(spark.range(20).selectExpr("id", "'w' AS word"), table_name="straight", connection=derby,
                         mode="overwrite", atomic=False, primary_key=("id",), batch_size=3)
    assert result == cf.LoadResult("straight", 20)
    assert cf.ext_load(spark.range(20, 25).selectExpr("id", "'w' AS word"), table_name="straight", connection=derby,
                       atomic=False).rows == 5
    assert cf.ext_scan(spark, table_name="straight", connection=derby).count() == 25
    with pytest.raises(cf.ExternalError):
        cf.ext_load(spark.range(1).selectExpr("id", "'w' AS word"), table_name="straight", connection=derby)


def test_the_input_is_computed_once(spark, derby):
    """The text is measured and written from the same checkpoint; otherwise random text would not match its width."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    frame = spark.range(0, 200, 1, 4).selectExpr("id", "cast(id AS string) AS word").mapInPandas(
        count, "id bigint, word string")
    result = cf.ext_load(frame, table_name="once", connection=derby, mode="overwrite", max_connections=2)
    assert result.rows == 200 and seen.value == 200
    assert cf.ext_scan(spark, table_name="once", connection=derby).count() == 200
