"""Single statements and catalogue look-ups on the driver.

Nothing here moves table data: rows come back only for aggregates and listings, whose size does not grow with the
tables. JDBC work goes through the driver class in Spark's own JVM, DB-API work through the Python module.
"""

from __future__ import annotations

import datetime as dt
import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

from crossfeed.connections import Connection
from crossfeed.errors import ExternalError, failed
from crossfeed.sources.dbapi import Session, stored
from crossfeed.sources.parts import CATALOGUE, has_catalogue

TABLE_KINDS = ("TABLE",)
VIEW_KINDS = ("VIEW", "SYSTEM VIEW")


@dataclass(frozen=True)
class Relation:
    schema: str
    name: str
    kind: str
    path: str


def open_admin(spark: SparkSession, connection: Connection):
    try:
        return _JdbcAdmin(spark, connection) if connection.kind == "jdbc" else _DbApiAdmin(connection)
    except ExternalError:
        raise
    except Exception as cause:
        raise failed(f"connect to '{connection.label}'", cause) from cause


class _Admin:
    quote_mark = '"'

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.close()

    def quote(self, name: str) -> str:
        return self.quote_mark + name.replace(self.quote_mark, self.quote_mark * 2) + self.quote_mark

    def path(self, schema: str | None, name: str) -> str:
        return ".".join(self.quote(part) for part in (schema, name) if part)

    def run(self, sql: str, operation: str = "execute statement"):
        try:
            self._run(sql)
        except Exception as cause:
            raise failed(operation, cause) from cause

    def rows(self, sql: str, operation: str = "execute statement") -> list[tuple]:
        try:
            return self._rows(sql)
        except Exception as cause:
            raise failed(operation, cause) from cause

    def find(self, name: str, schema: str | None = None) -> Relation:
        """The table or view of exactly this name; failing that, the only one that differs in letter case."""
        listed = self._named(name, schema)
        same = [one for one in listed if one.name == name] or [one for one in listed if one.name.lower() == name.lower()]
        if not same:
            raise ExternalError(f"No columns found for table '{name}'")
        if len(same) > 1:
            places = ", ".join(sorted(one.path for one in same))
            raise ExternalError(f"Table '{name}' is ambiguous, name its schema: {places}")
        return same[0]

    def exists(self, name: str, schema: str | None = None) -> bool:
        return any(one.name == name for one in self._named(name, schema))

    def remainder(self, expression: str, divisor: int) -> str:
        return f"MOD({expression}, {divisor})"

    def numbered(self, relation: str, columns: list[str]) -> str:
        """The columns of a relation and ``cf_n``, the place of each row in their order; NULLs of the first are left out."""
        names = ", ".join(columns)
        return (f"SELECT {names}, ROW_NUMBER() OVER (ORDER BY {names}) AS cf_n FROM {relation} "
                f"WHERE {columns[0]} IS NOT NULL")

    def every_nth(self, relation: str, columns: list[str], step: int) -> str:
        """A statement for the columns of every ``step``-th row but the first, sorted by them."""
        names = ", ".join(columns)
        return (f"SELECT {names} FROM ({self.numbered(relation, columns)}) cf_numbered "
                f"WHERE {self.remainder('cf_n - 1', step)} = 0 AND cf_n > 1 ORDER BY {names}")

    def ends(self, relation: str, name: str, counted: bool) -> tuple:
        """Smallest and largest value of a quoted column and, if counted, the number of rows."""
        counting = ", COUNT(*)" if counted else ""
        return self.rows(f"SELECT MIN({name}), MAX({name}){counting} FROM {relation}", f"find the bounds of {name}")[0]

    def filled(self, relation: str, name: str) -> int:
        """Rows where a quoted column is not NULL."""
        return int(self.rows(f"SELECT COUNT({name}) FROM {relation}", f"count the keys of {name}")[0][0])

    def nth_rows(self, relation: str, columns: list[str], step: int) -> list[tuple]:
        """The rows of ``every_nth``."""
        return self.rows(self.every_nth(relation, columns, step), f"find cuts of {columns[0]}")

    def time_literal(self, value: dt.date) -> str:
        return f"TIMESTAMP '{value}'" if isinstance(value, dt.datetime) else f"DATE '{value}'"

    def text_literal(self, value: str) -> str | None:
        """None for text that databases read in different ways."""
        return None if "\\" in value or "\0" in value else "'" + value.replace("'", "''") + "'"

    def bytes_literal(self, value: bytes) -> str:
        return f"X'{value.hex().upper()}'"

    def rename_sql(self, old: str, new: str, schema: str | None = None) -> str:
        return f"ALTER TABLE {self.path(schema, old)} RENAME TO {self.quote(new)}"


class _JdbcAdmin(_Admin):
    def __init__(self, spark: SparkSession, connection: Connection):
        jvm = spark._jvm
        properties = jvm.java.util.Properties()
        for key, value in connection.properties:
            properties.setProperty(key, value)
        if connection.username:
            properties.setProperty("user", connection.username)
        if connection.password:
            properties.setProperty("password", connection.password)
        manager = jvm.java.sql.DriverManager
        manager.setLoginTimeout(connection.timeout)
        if connection.driver:
            loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
            driver = jvm.java.lang.Class.forName(connection.driver, True, loader).newInstance()
            self._raw = driver.connect(connection.target, properties)
            if self._raw is None:
                raise ExternalError(f"Failed to connect to '{connection.label}': No suitable driver")
        else:
            self._raw = manager.getConnection(connection.target, properties)
        self._raw.setReadOnly(connection.read_only)
        self._timeout = connection.query_timeout
        self._target = connection.target
        self._meta = self._raw.getMetaData()
        self.quote_mark = self._meta.getIdentifierQuoteString().strip() or '"'
        self._spark = spark

    def close(self):
        if not self._raw.isClosed():
            if not self._raw.getAutoCommit():
                self._raw.rollback()
            self._raw.close()

    def time_literal(self, value):
        """The JDBC escape, which every driver puts into its own syntax."""
        return f"{{ts '{value}'}}" if isinstance(value, dt.datetime) else f"{{d '{value}'}}"

    def bytes_literal(self, value):
        if self._target.startswith("jdbc:postgresql:"):
            return f"'\\x{value.hex()}'::bytea"
        return f"0x{value.hex()}" if self._target.startswith("jdbc:sqlserver:") else super().bytes_literal(value)

    def remainder(self, expression, divisor):
        operator = self._target.startswith(("jdbc:sqlserver:", "jdbc:sqlite:"))
        return f"({expression}) % {divisor}" if operator else super().remainder(expression, divisor)

    def numbered(self, relation, columns):
        """Derby numbers rows in the order of an inner query only."""
        if not self._target.startswith("jdbc:derby:"):
            return super().numbered(relation, columns)
        names = ", ".join(columns)
        return (f"SELECT {names}, ROW_NUMBER() OVER () AS cf_n FROM (SELECT {names} FROM {relation} "
                f"WHERE {columns[0]} IS NOT NULL ORDER BY {names}) cf_sorted")

    def rename_sql(self, old, new, schema=None):
        if self._target.startswith("jdbc:derby:"):
            return f"RENAME TABLE {self.path(schema, old)} TO {self.quote(new)}"
        return super().rename_sql(old, new, schema)

    def _run(self, sql):
        self.update(sql)

    def update(self, sql: str) -> int:
        """Run a statement; the number of rows it changed, -1 if the driver does not tell."""
        statement = self._raw.createStatement()
        try:
            statement.setQueryTimeout(self._timeout)
            statement.execute(sql)
            return statement.getUpdateCount()
        finally:
            statement.close()

    @contextmanager
    def in_transaction(self, operation: str):
        """All statements inside, or none."""
        self._raw.setAutoCommit(False)
        try:
            yield
            self._raw.commit()
        except Py4JError as cause:
            self._raw.rollback()
            raise failed(operation, cause) from cause
        except Exception:
            self._raw.rollback()
            raise
        finally:
            self._raw.setAutoCommit(True)

    def _rows(self, sql):
        statement = self._raw.createStatement()
        try:
            statement.setQueryTimeout(self._timeout)
            result = statement.executeQuery(sql)
            width = result.getMetaData().getColumnCount()
            return [tuple(_python(cell) for cell in row) for row in _cursor(result, range(1, width + 1))]
        finally:
            statement.close()

    def relations(self, kinds: tuple[str, ...]) -> list[Relation]:
        return self._listing(None, "%", kinds)

    def home(self) -> str | None:
        """The schema that unqualified names stand for."""
        return self._raw.getSchema()

    def _named(self, name, schema):
        """The arguments of the listing are LIKE patterns: wildcards are escaped here, equality is the caller's.

        Whatever the database lists by that name counts: synonyms, system tables, foreign and partitioned tables too.
        """
        found: dict[str, Relation] = {}
        for spelled in dict.fromkeys((name, name.upper(), name.lower())):
            pattern = self._escaped(spelled)
            for one in self._listing(schema, pattern, None):
                if not schema or one.schema.lower() == schema.lower():
                    found[one.path] = one
        return list(found.values())

    def _escaped(self, name: str) -> str:
        escape = self._meta.getSearchStringEscape() or ""
        for sign in (escape, "%", "_") if escape else ():
            name = name.replace(sign, escape + sign)
        return name

    def _listing(self, schema, pattern, kinds):
        result = self._meta.getTables(None, schema, pattern, _java_strings(self._spark, kinds) if kinds else None)
        return [Relation(space or "", name, kind, self.path(space, name))
                for space, name, kind in _cursor(result, (2, 3, 4))]

    def text_widths(self, name: str, schema: str | None = None) -> dict[str, int]:
        """Declared widths of the VARCHAR and CHAR columns of a table."""
        relation = self.find(name, schema)
        result = self._meta.getColumns(None, relation.schema or None, self._escaped(relation.name), None)
        listed = _cursor(result, ("TABLE_NAME", "COLUMN_NAME", "TYPE_NAME", "COLUMN_SIZE"))
        return {column: int(size) for table, column, kind, size in listed
                if table == relation.name and kind in ("VARCHAR", "CHAR")}

    def not_null_columns(self, relation: Relation) -> list[str]:
        result = self._meta.getColumns(None, relation.schema or None, self._escaped(relation.name), None)
        return [column for table, column, _, nullable in sorted(
            _cursor(result, ("TABLE_NAME", "COLUMN_NAME", "ORDINAL_POSITION", "IS_NULLABLE")), key=lambda row: row[2])
            if table == relation.name and nullable == "NO"]

    def key_columns(self, relation: Relation) -> list[str]:
        result = self._meta.getPrimaryKeys(None, relation.schema or None, relation.name)
        return [name for _, name in sorted(_cursor(result, ("KEY_SEQ", "COLUMN_NAME")))]


def _cursor(result, columns):
    try:
        while result.next():
            yield tuple(result.getObject(column) for column in columns)
    finally:
        result.close()


def _python(cell):
    """A Java date or timestamp as a Python one; py4j converts the rest."""
    kind = cell.getClass().getName() if hasattr(cell, "getClass") else ""
    if kind == "java.sql.Timestamp":
        return dt.datetime.fromisoformat(cell.toString())
    if kind == "java.util.UUID":
        return cell.toString()
    return dt.date.fromisoformat(cell.toString()) if kind == "java.sql.Date" else cell


def _java_strings(spark, values):
    made = spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, len(values))
    for place, value in enumerate(values):
        made[place] = value
    return made


class _DbApiAdmin(_Admin):
    def __init__(self, connection: Connection):
        self._session = Session(connection.dbapi_options(), read_only=connection.read_only)
        if self._session.is_sqlite:
            self._session.run("SELECT count(*) FROM sqlite_master")

    @property
    def session(self) -> Session:
        return self._session

    def close(self):
        self._session.raw.close()

    def _run(self, sql):
        self._session.run(sql)
        if not self._session.is_sqlite and not self._session.guarded:
            self._session.commit()

    def _rows(self, sql):
        return self._session.cursor(sql).fetchall()

    def home(self) -> str | None:
        return None

    def ends(self, relation, name, counted):
        """SQLite finds one end at a time in an index, and in each part by itself; a query is gone through once."""
        if not self._session.is_sqlite or relation.startswith("("):
            return super().ends(relation, name, counted)
        split = self._session.parts.get(relation)
        places = [f"main.{relation}", *(path for path, _ in split.tables)] if split else [relation]
        least, most = (" UNION ALL ".join(f"SELECT {end}({name}) AS v FROM {place}" for place in places)
                       for end in ("MIN", "MAX"))
        found = self.rows(f"SELECT (SELECT MIN(v) FROM ({least})), (SELECT MAX(v) FROM ({most}))",
                          f"find the bounds of {name}")[0]
        return (*found, self._size(relation)) if counted else found

    def filled(self, relation, name):
        split = self._session.parts.get(relation)
        if not split or name != self.quote(split.order[0]):
            return super().filled(relation, name)
        return self._size(relation) - self._rows(f"SELECT COUNT(*) FROM {relation} WHERE {name} IS NULL")[0][0]

    def nth_rows(self, relation, columns, step):
        """The rows of a split table lie in its order: one look-up by row number each, and no sort."""
        split = self._session.parts.get(relation)
        if not split or columns != [self.quote(name) for name in split.order][:len(columns)] or self._own_rows(relation):
            return super().nth_rows(relation, columns, step)
        names, found = ", ".join(columns), []
        place = self._size(relation) - self.filled(relation, columns[0]) + step + 1
        for path, rows in split.tables:
            if self._rows(f"SELECT (SELECT MIN(rowid) FROM {path}), (SELECT MAX(rowid) FROM {path})")[0] != (1, rows):
                return super().nth_rows(relation, columns, step)
            while place <= rows:
                found += self._rows(f"SELECT {names} FROM {path} WHERE rowid = {place}")
                place += step
            place -= rows
        if any(None in row for row in found) or found != sorted(found):
            return super().nth_rows(relation, columns, step)
        return found

    def part_tables(self, name: str) -> list[tuple[str, str]]:
        """File and table of every part of a table."""
        if not self._session.is_sqlite or not has_catalogue(self._session.raw):
            return []
        return self._session.cursor(f"SELECT file, stored FROM {CATALOGUE} WHERE relation = ?", [name]).fetchall()

    def columns_sql(self, name: str) -> str:
        """The columns of a SQLite table as a statement declares them."""
        listed = self._rows(f"PRAGMA main.table_info({self.quote(name)})")
        columns = [f"{self.quote(row[1])} {row[2]}" + " NOT NULL" * bool(row[3]) for row in listed]
        keys = [self.quote(row[1]) for row in sorted(listed, key=lambda row: row[5]) if row[5]]
        return f"({', '.join(columns + [f'PRIMARY KEY ({', '.join(keys)})'] * bool(keys))})"

    def forgotten(self, name: str) -> list[str]:
        """Statements after which a table has no parts."""
        text = name.replace("'", "''")
        return [f"DELETE FROM {CATALOGUE} WHERE relation = '{text}'"] if self.part_tables(name) else []

    def _size(self, relation: str) -> int:
        split = self._session.parts.get(relation)
        if not split:
            return int(self._rows(f"SELECT COUNT(*) FROM {relation}")[0][0])
        return self._own_rows(relation) + sum(rows for _, rows in split.tables)

    def _own_rows(self, relation: str) -> int:
        """Rows of a split table that are in no part."""
        return self._rows(f"SELECT COUNT(*) FROM main.{relation}")[0][0]

    def relations(self, kinds: tuple[str, ...]) -> list[Relation]:
        if self._session.is_sqlite:
            listed = [("", name, kind.upper()) for name, kind in self._rows(
                "SELECT name, type FROM sqlite_master WHERE type IN ('table', 'view') AND name NOT LIKE 'sqlite!_%' "
                f"ESCAPE '!' AND name <> '{CATALOGUE}' ORDER BY name")]
        else:
            listed = [(schema, name, "VIEW" if "VIEW" in kind else "TABLE") for schema, name, kind in self._rows(
                "SELECT table_schema, table_name, table_type FROM information_schema.tables ORDER BY 1, 2")]
        return [Relation(schema, name, kind, self.path(schema, name)) for schema, name, kind in listed if kind in kinds]

    def remainder(self, expression, divisor):
        """SQLite may lack MOD."""
        return f"({expression}) % {divisor}" if self._session.is_sqlite else super().remainder(expression, divisor)

    def bytes_literal(self, value):
        """DuckDB writes bytes as escapes in a text."""
        if self._session.module.__name__ == "duckdb":
            return "'" + "".join(f"\\x{byte:02X}" for byte in value) + "'::BLOB"
        return super().bytes_literal(value)

    def time_literal(self, value):
        """SQLite keeps times as ISO text."""
        return f"'{stored(value)}'" if self._session.is_sqlite else super().time_literal(value)

    def _named(self, name, schema):
        return [one for one in self.relations(TABLE_KINDS + VIEW_KINDS)
                if one.name.lower() == name.lower() and (not schema or one.schema.lower() == schema.lower())]

    def not_null_columns(self, relation: Relation) -> list[str]:
        if self._session.is_sqlite:
            return [row[1] for row in self._rows(f"PRAGMA main.table_info({self.quote(relation.name)})") if row[3]]
        return [name for name, nullable in self._rows(
            "SELECT column_name, is_nullable FROM information_schema.columns "
            f"WHERE table_name = '{relation.name.replace(chr(39), chr(39) * 2)}' ORDER BY ordinal_position")
            if str(nullable).upper() in ("NO", "FALSE")]

    def key_columns(self, relation: Relation) -> list[str]:
        if not self._session.is_sqlite:
            return self._declared_key(relation)
        rows = self._rows(f"PRAGMA main.table_info({self.quote(relation.name)})")
        return [row[1] for row in sorted(rows, key=lambda row: row[5]) if row[5]]


    def _declared_key(self, relation: Relation) -> list[str]:
        """The primary key by the information schema; none where the database has no such tables."""
        def text(value: str) -> str:
            return "'" + value.replace("'", "''") + "'"
        where = f"c.table_name = {text(relation.name)} AND c.constraint_type = 'PRIMARY KEY'"
        if relation.schema:
            where += f" AND c.table_schema = {text(relation.schema)}"
        try:
            return [name for name, _ in self._rows(
                "SELECT k.column_name, k.ordinal_position FROM information_schema.table_constraints c "
                "JOIN information_schema.key_column_usage k ON k.constraint_name = c.constraint_name "
                f"AND k.table_schema = c.table_schema AND k.table_name = c.table_name WHERE {where} ORDER BY 2")]
        except Exception:
            self._session.rollback()
            return []


def scratch_name(base: str) -> str:
    return f"{base}_cf_{uuid.uuid4().hex[:10]}"
