import pytest

import crossfeed as cf
from crossfeed import connections
from crossfeed.functions.types import as_integer, as_text, writable


def test_bad_sql_fails_when_the_frame_is_made(spark, external):
    with pytest.raises(cf.ExternalError, match="Failed to prepare statement"):
        cf.ext_query(spark, connection=external, query="SELECT * FROM invalid syntax")
    for empty in ("", " ; "):
        with pytest.raises(cf.ExternalError, match="Failed"):
            cf.ext_query(spark, connection=external, query=empty)


def test_missing_table(spark, external):
    with pytest.raises(cf.ExternalError, match="No columns found for table 'non_existent_table'"):
        cf.ext_scan(spark, table_name="non_existent_table", connection=external)


@pytest.mark.parametrize("name", ["invalid_connection", "NULL"])
def test_unknown_connection_is_named(spark, name):
    with pytest.raises(cf.ExternalError, match=f"Failed to connect to '{name}'"):
        cf.ext_query(spark, connection=name, query="SELECT 1")


def test_no_suitable_driver(spark):
    with pytest.raises(cf.ExternalError, match="Failed to connect to 'jdbc:nothing'"):
        cf.ext_scan(spark, table_name="t", connection="jdbc:nothing://host/db")


def test_required_and_typed_arguments(spark, external):
    cases = [
        (lambda: cf.ext_scan(spark, connection=external), "Missing required parameter 'table_name'"),
        (lambda: cf.ext_scan(spark, table_name="t"), "Missing required parameter 'connection'"),
        (lambda: cf.ext_query(spark, connection=external), "Missing required parameter 'query'"),
        (lambda: cf.ext_exec(spark, connection=external), "Missing required parameter 'sql'"),
        (lambda: cf.ext_scan(spark, table_name=5, connection=external), "Parameter 'table_name' must be a string"),
        (lambda: cf.ext_scan(spark, table_name="t", connection=external, all_varchar="yes"),
         "Parameter 'all_varchar' must be a boolean"),
        (lambda: cf.ext_scan(spark, table_name="t", connection=external, encoding=1),
         "Parameter 'encoding' must be a string"),
        (lambda: cf.ext_scan(spark, table_name="t", connection=external, timeout="60"), "Parameter 'timeout'"),
        (lambda: cf.ext_scan(spark, table_name="t", connection=""), "the connection is empty"),
        (lambda: cf.ext_attach(spark, connection=external, overwrite=1), "Parameter 'overwrite' must be a boolean"),
    ]
    for call, message in cases:
        with pytest.raises(cf.ExternalError, match=message):
            call()


def test_types_without_conversion_are_named(spark):
    frame = spark.sql("SELECT array(1) AS listed, 1 AS id")
    with pytest.raises(cf.ExternalError, match="Cannot write column 'listed': no conversion for type 'array<int>'"):
        writable(frame)
    with pytest.raises(cf.ExternalError, match="No text format for type 'array<int>'"):
        as_text(frame["listed"], frame.schema["listed"].dataType)
    with pytest.raises(cf.ExternalError, match="No conversion to integer type 'huge'"):
        as_integer(frame["id"], "huge")


def test_connection_forms():
    made = connections.resolve("Driver=org.example.Driver;Url={jdbc:example://h/db;a=b};Uid=me;Pwd=secret;ssl=true")
    assert (made.kind, made.target, made.driver) == ("jdbc", "jdbc:example://h/db;a=b", "org.example.Driver")
    assert made.jdbc_options()["user"] == "me" and made.jdbc_options()["password"] == "secret"
    assert made.jdbc_options()["ssl"] == "true" and "secret" not in repr(made)
    assert connections.resolve("dbapi:sqlite3:/tmp/a:b.db").target == "/tmp/a:b.db"
    cf.register_connection("named", "jdbc:example://h/db", username="me", password="one", session_init="SET x = 1",
                           login_timeout_property="loginTimeout")
    again = connections.resolve("named", password="two", timeout=7, query_timeout=9)
    assert again.username == "me" and again.password == "two" and again.read_only
    assert again.jdbc_options()["loginTimeout"] == "7" and again.jdbc_options()["queryTimeout"] == "9"
    assert again.jdbc_options()["sessionInitStatement"] == "SET x = 1"
    assert connections.resolve("named").timeout == 60
    cf.drop_connection("named")
    with pytest.raises(cf.ExternalError, match="no Url attribute"):
        connections.resolve("Driver=x;Database=y")


def test_readers_cannot_write(spark, external):
    cf.ext_load(spark.range(3).toDF("id"), table_name="guarded", connection=external, mode="overwrite")
    with pytest.raises(cf.ExternalError):
        cf.ext_exec(spark, connection=external, sql='DELETE FROM "guarded"', read_only=True)
    with pytest.raises(cf.ExternalError):
        cf.ext_query(spark, connection=external, query='DELETE FROM "guarded"')
    assert cf.ext_scan(spark, table_name="guarded", connection=external).count() == 3


def test_credentials_stay_out_of_plans_and_views(spark, derby):
    cf.ext_load(spark.range(3).toDF("id"), table_name="secretive", connection=derby, mode="overwrite")
    cf.ext_attach(spark, connection=derby, username="app", password="tell-nobody", prefix="sec_", overwrite=True,
                  tables_like="secretive")
    frame = spark.table("sec_secretive")
    assert frame.count() == 3
    assert "tell-nobody" not in frame._jdf.queryExecution().toString()
