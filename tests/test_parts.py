"""SQLite tables in several files, written by several tasks at a time."""

import sqlite3

import pytest

import crossfeed as cf
from crossfeed import connections, fixtures
from crossfeed.admin import _Admin, open_admin
from crossfeed.errors import ExternalError
from crossfeed.sources import parts, splits

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def split(spark, tmp_path):
    """A database with 400 rows in parts; a key of ten has half of them, and four keys are NULL."""
    cf.register_connection("split", f"dbapi:sqlite3:{tmp_path}/db.sqlite")
    frame = spark.range(400).selectExpr("if(id < 200, 10, if(id < 204, null, id % 37)) as k", "id as t",
                                        "concat('text ', id) as name")
    assert cf.ext_load(frame, table_name="pairs", connection="split", split_by=("k", "t"), stable_input=True).rows == 400
    return str(tmp_path / "db.sqlite")


def held(spark, **options):
    return sorted((row["k"] is not None, row["k"], row["t"], row["name"])
                  for row in cf.ext_scan(spark, table_name="pairs", connection="split", **options).collect())


def expected():
    keys = [10 if n < 200 else None if n < 204 else n % 37 for n in range(400)]
    return sorted((key is not None, key, n, f"text {n}") for n, key in enumerate(keys))


def test_every_task_writes_a_file_and_the_table_is_whole(spark, split):
    with open_admin(spark, connections.resolve("split")) as admin:
        assert len(admin.part_tables("pairs")) > 1
        assert [one.name for one in admin.relations(("TABLE", "VIEW"))] == ["pairs"]
    assert held(spark, num_partitions=1) == expected()
    assert held(spark, partition_column="k", num_partitions=5) == expected()
    assert held(spark, partition_column="k", tie_column="t", num_partitions=7, balanced=True) == expected()
    counted = cf.ext_query(spark, connection="split", query='SELECT COUNT(*) AS n, MAX("t") AS t FROM "pairs"')
    assert [tuple(row) for row in counted.collect()] == [(400, 399)]


@pytest.mark.parametrize("names", [["k"], ["k", "t"]])
@pytest.mark.parametrize("step", [1, 7, 50, 399])
def test_cuts_by_row_number_are_those_of_the_histogram(spark, split, names, step, monkeypatch):
    with open_admin(spark, connections.resolve("split")) as admin:
        quoted = [admin.quote(name) for name in names]
        by_sort = admin.rows(admin.every_nth('"pairs"', quoted, step))
        asked = []
        monkeypatch.setattr(admin, "every_nth", lambda *given: asked.append(given) or "SELECT 1")
        assert admin.nth_rows('"pairs"', quoted, step) == by_sort and not asked
        assert admin.filled('"pairs"', '"k"') == _Admin.filled(admin, '"pairs"', '"k"') == 396
        assert splits.key_bounds(admin, '"pairs"', "k") == (0, 36, 400)
        assert splits.key_bounds(admin, '"pairs"', "t", counted=False) == (0, 399, None)


def test_rows_added_later_and_views_are_seen(spark, split):
    more = spark.sql("SELECT 99L AS k, 1L AS t, 'later' AS name")
    cf.ext_load(more, table_name="pairs", connection="split")
    cf.ext_exec(spark, connection="split", sql='CREATE VIEW "late" AS SELECT "name" FROM "pairs" WHERE "k" > 35')
    assert held(spark, partition_column="k", tie_column="t", num_partitions=6, balanced=True) == sorted(
        expected() + [(True, 99, 1, "later")])
    late = cf.ext_scan(spark, table_name="late", connection="split", partition_column="name", num_partitions=2)
    assert {row[0] for row in late.collect()} == {row[3] for row in expected() if row[1] == 36} | {"later"}


@pytest.mark.parametrize("truncate", [False, True])
@pytest.mark.parametrize("again", [(), ("k", "t")])
def test_a_new_load_leaves_nothing_of_the_old(spark, split, truncate, again):
    new = spark.sql("SELECT 1L AS k, 2L AS t, 'new' AS name")
    cf.ext_load(new, table_name="pairs", connection="split", mode="overwrite", truncate=truncate, split_by=again)
    assert held(spark) == [(True, 1, 2, "new")]
    if again:
        names = [name for number in range(parts.file_count()) for (name,) in tables(f"{split}-part{number}")]
        assert len(names) == 1


def test_a_failed_load_leaves_the_table_as_it_was(spark, split):
    bad = spark.range(100).selectExpr("id as k", "id as t", "if(id = 77, raise_error('lost'), 'x') as name")
    with pytest.raises(ExternalError):
        cf.ext_load(bad, table_name="pairs", connection="split", mode="overwrite", split_by=("k",))
    assert held(spark) == expected()


def test_keys_stay_unique_and_unsuited_columns_are_refused(spark, split):
    double = spark.sql("SELECT id % 99 AS k, 1.5D AS d FROM range(100)")
    with pytest.raises(ExternalError, match="UNIQUE"):
        cf.ext_load(double, table_name="keyed", connection="split", primary_key=("k",), split_by=("k",))
    for columns, key in ((("d",), ()), (("k",), ("d",))):
        with pytest.raises(ExternalError, match="split"):
            cf.ext_load(double, table_name="keyed", connection="split", primary_key=key, split_by=columns)


def test_the_staged_tables_are_split(spark):
    spark.conf.set(fixtures.KIND_SETTING, "sqlite")
    try:
        name = fixtures.source(spark, SF_DIR, "lineitem", "orders", "documents")
        with open_admin(spark, connections.resolve(name)) as admin:
            assert all(len(admin.part_tables(table)) > 1 for table in ("lineitem", "orders", "documents"))
            assert admin.key_columns(admin.find("orders")) == ["o_orderkey"]
    finally:
        spark.conf.unset(fixtures.KIND_SETTING)


def tables(path):
    try:
        with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as raw:
            return raw.execute("SELECT name FROM sqlite_master WHERE type = 'table'").fetchall()
    except sqlite3.OperationalError:
        return []


def test_computed_columns_are_typed_by_the_tasks_that_read_them(spark, split, monkeypatch):
    """Each range has its own kinds of values: whole numbers in one, reals, text or bytes in others."""
    from crossfeed.sources import scan
    asked, describe = [], scan.describe
    monkeypatch.setattr(scan, "describe", lambda session, relation, look: asked.append(look) or describe(session, relation, look))
    query = """SELECT "t", CASE WHEN "t" < 200 THEN 1 ELSE 0.5 END AS mixed, CASE WHEN "t" < 200 THEN 1 ELSE 'x' END AS odd,
        "t" + 0 AS number, CASE WHEN "t" < 100 THEN 9007199254740993 ELSE 0.5 END AS large, NULL AS empty FROM "pairs" """
    found = cf.ext_query(spark, connection="split", query=query, partition_column="t", num_partitions=4)
    assert asked[0] is not None
    assert [field.dataType.simpleString() for field in found.schema] == [
        "bigint", "double", "string", "bigint", "string", "string"]
    assert sorted(row["number"] for row in found.collect()) == list(range(400))
