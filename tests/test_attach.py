import pytest

import crossfeed as cf
from crossfeed.admin import _JdbcAdmin
from crossfeed.sources.attach import like_pattern


@pytest.fixture
def stocked(spark, external):
    for name in ("stock", "stock_old", "other"):
        cf.ext_load(spark.range(5).selectExpr("id", f"'{name}' AS word"), table_name=name, connection=external,
                    mode="overwrite", truncate=True, column_types={"word": "VARCHAR(20)"})
    with_view = cf.ext_query(spark, connection=external, query='SELECT 1 AS n FROM "stock"')
    assert with_view.count() == 5
    try:
        cf.ext_exec(spark, connection=external, sql='CREATE VIEW "stock_view" AS SELECT "id" FROM "stock" WHERE "id" > 2')
    except cf.ExternalError:
        pass
    return external


def test_tables_and_views_are_attached(spark, stocked):
    report = cf.ext_attach(spark, connection=stocked, prefix="a1_", overwrite=True, tables_like=["stock%", "other"])
    assert sorted((r["name"], r["kind"], r["status"]) for r in report.collect()) == [
        ("a1_other", "TABLE", "attached"), ("a1_stock", "TABLE", "attached"), ("a1_stock_old", "TABLE", "attached"),
        ("a1_stock_view", "VIEW", "attached")]
    assert spark.table("a1_stock_view").count() == 2
    joined = spark.sql("SELECT count(*) AS n FROM a1_stock s JOIN a1_stock_view v ON s.id = v.id")
    assert joined.first()["n"] == 2


def test_taken_names_need_overwrite(spark, stocked):
    spark.range(1).createOrReplaceTempView("a2_stock")
    with pytest.raises(cf.ExternalError, match="'a2_stock' already exists"):
        cf.ext_attach(spark, connection=stocked, prefix="a2_", tables_like="stock")
    assert spark.table("a2_stock").columns == ["id"]
    cf.ext_attach(spark, connection=stocked, prefix="a2_", tables_like="stock", overwrite=True)
    assert spark.table("a2_stock").columns == ["id", "word"]


def test_partitions_where_there_is_a_key(spark, stocked):
    cf.ext_load(spark.range(100).toDF("id"), table_name="numbered", connection=stocked, mode="overwrite",
                primary_key=("id",))
    with pytest.warns(UserWarning, match="stock_view.* has no key to partition by"):
        report = cf.ext_attach(spark, connection=stocked, prefix="a5_", tables_like=["stock_view", "numbered"],
                               overwrite=True, num_partitions=4)
    assert {row["status"] for row in report.collect()} == {"attached"}
    assert spark.table("a5_numbered").rdd.getNumPartitions() == 4
    assert spark.table("a5_stock_view").rdd.getNumPartitions() == 1


def test_options_reach_every_view(spark, stocked):
    cf.ext_attach(spark, connection=stocked, prefix="a3_", tables_like="stock", overwrite=True, all_varchar=True)
    assert spark.table("a3_stock").dtypes == [("id", "string"), ("word", "string")]


def test_views_that_cannot_be_listed_are_reported(spark, derby, monkeypatch):
    cf.ext_load(spark.range(5).toDF("id"), table_name="alone", connection=derby, mode="overwrite")
    listing = _JdbcAdmin.relations

    def only_tables(self, kinds):
        if "VIEW" in kinds:
            raise RuntimeError("no right to list views")
        return listing(self, kinds)

    monkeypatch.setattr(_JdbcAdmin, "relations", only_tables)
    report = cf.ext_attach(spark, connection=derby, prefix="a4_", tables_like="alone", overwrite=True).collect()
    assert {row["status"] for row in report} == {"attached", "failed"}
    assert spark.table("a4_alone").count() == 5


@pytest.mark.parametrize("pattern, name, found", [
    ("a_b", "axb", True), ("a\\_b", "axb", False), ("a\\_b", "a_b", True), ("a%", "ABC", True), ("a.b", "axb", False)])
def test_like_patterns(pattern, name, found):
    assert bool(like_pattern(pattern).fullmatch(name)) is found
