"""Partitions of any ordered key: every row once, in even numbers, over both kinds of database."""

import warnings

import pytest
from pyspark.sql import functions as F

import crossfeed as cf
from crossfeed import connections
from crossfeed.admin import open_admin
from crossfeed.sources.splits import AFTER, _between, balanced_predicates


def sizes_of(frame):
    return sorted(row["count"] for row in frame.groupBy(F.spark_partition_id()).count().collect())


def wrote(spark, external, name, columns, rows, key=""):
    """A table with columns of remote types, filled by the database."""
    made = f", PRIMARY KEY ({key})" if key else ""
    cf.ext_exec(spark, connection=external, sql=f'CREATE TABLE "{name}" ({columns}{made})')
    with open_admin(spark, connections.resolve(external, read_only=False)) as admin:
        for start in range(0, len(rows), 500):
            admin.run(f'INSERT INTO "{name}" VALUES ' + ", ".join(rows[start:start + 500]))


def test_decimal_keys_between_whole_numbers(spark, external):
    """Whole bounds, fractions between them: as key, with a tie column, by default and on request."""
    rows = [f"({n // 3 + (n % 3) * 0.25:.2f}, {n})" for n in range(3001)]
    wrote(spark, external, "fractions", '"k" NUMERIC(10,2) NOT NULL, "n" INTEGER NOT NULL', rows, '"k", "n"')
    for options in ({}, {"partition_column": "k", "balanced": True}, {"partition_column": "k"},
                    {"partition_column": "k", "balanced": True, "tie_column": "n"}, {"partition_column": "n", "tie_column": "k"}):
        frame = cf.ext_scan(spark, table_name="fractions", connection=external, num_partitions=8, **options)
        assert sorted(row["n"] for row in frame.select("n").collect()) == list(range(3001)), options
        assert len(sizes_of(frame)) == 8 and max(sizes_of(frame)) <= 400, (options, sizes_of(frame))
    assert cf.ext_scan(spark, table_name="fractions", connection=external).count() == 3001


def test_decimal_tie_column(spark, external):
    """One key holds half of all rows; its ties are fractions, some of them NULL."""
    rows = [f"(7, {'NULL' if n % 10 == 0 else f'{n // 4}.{n % 4 * 25:02d}'}, {n})" for n in range(2000)]
    rows += [f"({n % 400}, {n}.50, {n})" for n in range(2000, 4000)]
    wrote(spark, external, "ties", '"k" INTEGER, "t" NUMERIC(10,2), "n" INTEGER', rows)
    frame = cf.ext_scan(spark, table_name="ties", connection=external, partition_column="k", balanced=True, num_partitions=10,
                        tie_column="t")
    assert sorted(row["n"] for row in frame.select("n").collect()) == list(range(4000))
    assert max(sizes_of(frame)) <= 1000, sizes_of(frame)


@pytest.mark.parametrize("kind, value", [
    ("DOUBLE", lambda n: f"{n * n / 7.0!r}"), ("DATE", lambda n: f"'20{n % 90 + 10}-01-{n % 28 + 1:02d}'"),
    ("TIMESTAMP", lambda n: f"'2024-01-01 00:{n % 60:02d}:00.{n:06d}'"), ("VARCHAR(20)", lambda n: f"'k{n * 37 % 1000}'"),
    ("BIGINT", lambda n: f"{n ** 5}"), ("NUMERIC(20,4)", lambda n: f"{n ** 3 / 16:.4f}")])
def test_skewed_keys_of_every_kind_make_even_partitions(spark, external, kind, value):
    name = "even_" + kind.split("(")[0].lower()
    rows = [f"({'NULL' if n % 50 == 0 else value(n)}, {n})" for n in range(1000)]
    wrote(spark, external, name, f'"k" {kind}, "n" INTEGER', rows)
    frame = cf.ext_scan(spark, table_name=name, connection=external, partition_column="k", balanced=True, num_partitions=5)
    assert sorted(row["n"] for row in frame.select("n").collect()) == list(range(1000))
    assert len(sizes_of(frame)) == 5 and max(sizes_of(frame)) <= 240, sizes_of(frame)


def test_byte_keys(spark, derby, lite):
    for external, kind, mark in ((derby, "VARCHAR(8) FOR BIT DATA", "X"), (lite, "BLOB", "x")):
        rows = [f"({mark}'{n * 2654435761 % 2**32:08X}', {n})" for n in range(900)]
        wrote(spark, external, "raw_keys", f'"k" {kind} NOT NULL, "n" INTEGER', rows, '"k"')
        frame = cf.ext_scan(spark, table_name="raw_keys", connection=external, num_partitions=6)
        assert sorted(row["n"] for row in frame.select("n").collect()) == list(range(900))
        assert sizes_of(frame) == [150] * 6


def test_other_driver_finds_its_key(spark, tmp_path, monkeypatch):
    """Keys by the information schema, UUIDs and bytes among them, each table read in parallel."""
    duckdb = pytest.importorskip("duckdb")
    monkeypatch.setattr("crossfeed.sources.splits.FEWEST_ROWS", 100)
    path = str(tmp_path / "keyed.db")
    with duckdb.connect(path) as database:
        for name, kind, value in (("uuids", "UUID", "md5(n::VARCHAR)::UUID"), ("raws", "BLOB", "md5(n::VARCHAR)::BLOB"),
                                  ("texts", "VARCHAR", "md5(n::VARCHAR)"), ("numbers", "BIGINT", "n * n"),
                                  ("pairs", "INTEGER, n2 INTEGER", "(n % 2)::INTEGER, n::INTEGER")):
            key = "k, n2" if name == "pairs" else "k"
            database.execute(f"CREATE TABLE {name} (k {kind}, n BIGINT, PRIMARY KEY ({key}))")
            database.execute(f"INSERT INTO {name} SELECT {value}, n FROM range(1000) t(n)")
    cf.register_connection("keyed", f"dbapi:duckdb:{path}", properties={"read_only": "true"})
    for name in ("uuids", "raws", "texts", "numbers", "pairs"):
        frame = cf.ext_scan(spark, table_name=name, connection="keyed")
        assert sorted(row["n"] for row in frame.select("n").collect()) == list(range(1000)), name
        assert frame.rdd.getNumPartitions() >= 4 and max(sizes_of(frame)) <= (600 if name == "numbers" else 260), (name, sizes_of(frame))


def test_one_histogram_statement(spark, external, monkeypatch):
    """However many partitions, the database answers one statement besides the count."""
    cf.ext_load(spark.range(5000).selectExpr("concat('k', id) AS k", "id"), table_name="counted_cuts", connection=external,
                mode="overwrite", primary_key=("k",))
    asked = []
    with open_admin(spark, connections.resolve(external)) as admin:
        path, plain = admin.find("counted_cuts").path, admin.rows
        monkeypatch.setattr(admin, "rows", lambda *args: asked.append(args[0]) or plain(*args), raising=False)
        assert len(balanced_predicates(admin, path, "k", 100)) == 100
    assert len(asked) == 2


def test_a_relation_without_a_key_is_read_with_a_warning(spark, external):
    cf.ext_load(spark.range(10), table_name="no_key", connection=external, mode="overwrite")
    with pytest.warns(UserWarning, match="no key to partition by"):
        frame = cf.ext_scan(spark, table_name="no_key", connection=external)
    assert frame.rdd.getNumPartitions() == 1
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        cf.ext_scan(spark, table_name="no_key", connection=external, num_partitions=1)


def test_attach_counts_nothing(spark, external, monkeypatch):
    from crossfeed import admin as admin_module
    cf.ext_load(spark.range(40_000).selectExpr("id", "id % 7 AS n"), table_name="spread", connection=external, mode="overwrite",
                primary_key=("id",))
    asked, plain = [], admin_module._Admin.rows
    monkeypatch.setattr(admin_module._Admin, "rows", lambda self, sql, *rest: asked.append(sql) or plain(self, sql, *rest))
    cf.ext_attach(spark, connection=external, tables_like="spread", overwrite=True)
    assert not [sql for sql in asked if "COUNT(" in sql]
    assert spark.table("spread").rdd.getNumPartitions() == 4 and spark.table("spread").count() == 40_000


def test_ranges_meet_without_gap_or_overlap():
    """All cuts of one key, of ties and of NULLs, against every place a row can have."""
    import sqlite3
    database = sqlite3.connect(":memory:")
    database.execute("CREATE TABLE t (k, t)")
    values = [None, -1, 0, 0.5, 1, 1.5, 2, 3]
    database.executemany("INSERT INTO t VALUES (?, ?)", [(a, b) for a in values for b in values])
    for cuts in ([("0", None)], [("0", None), ("1", "0.5"), ("1", "2"), ("2", None)], [("1", None), ("1", AFTER)],
                 [("0", None), ("0", "1"), ("1", "1"), ("2", None), ("2", AFTER)], [("1", "0"), ("1", "1.5")]):
        predicates = _between(["k", "t"], cuts)
        found = [rowid for one in predicates for (rowid,) in database.execute(f"SELECT rowid FROM t WHERE {one}")]
        assert sorted(found) == list(range(1, 65)), cuts
