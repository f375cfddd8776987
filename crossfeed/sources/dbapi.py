"""Python data source over a DB-API 2 driver, for databases without a JDBC driver.

Every task opens its own connection. Reads yield Arrow batches of ``fetchsize`` rows, one Spark partition per
predicate. Writes go to a staging table under a tag per task attempt; the commit moves only the rows of the attempts
Spark accepted, so a repeated task leaves no second copy.
"""

from __future__ import annotations

import importlib
import json
import re
import uuid
from dataclasses import dataclass
from decimal import Decimal
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_type

from crossfeed.errors import ExternalError
from crossfeed.functions.remote_types import DECIMAL_NAMES, MAX_PRECISION, SIMPLE_TYPES, base_name, spark_type
from crossfeed.sources.parts import CATALOGUE, CREATE_CATALOGUE, attach, file_of
from crossfeed.sources.splits import axis_of, range_predicates

SOURCE_NAME = "crossfeed_dbapi"
NAMED_TYPES = {*SIMPLE_TYPES, *DECIMAL_NAMES, "varchar", "char", "text", "string", "time", "uuid"}
FETCH_SIZE = 10_000
DEFAULT_TIMEOUT = 60
#: Bytes of a batch that a task reads, or writes at once, and the rows that SQLite is asked for at a time.
BATCH_BYTES, PIECE_BYTES, STEP_ROWS = 8 * 1024 * 1024, 8 * 1024 * 1024, 256
#: Rows of a transaction and cached bytes of a task that writes a file of its own.
PART_ROWS, PART_CACHE_KB = 100_000, 16 * 1024
TAG_COLUMN = "cf_attempt"
WRITE_WAIT_SECONDS = 600


_READS = re.compile(r"\s*(SELECT|VALUES|SHOW|DESCRIBE|EXPLAIN)\b", re.IGNORECASE)


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class Session:
    """One DB-API connection with explicit transactions; with ``split``, tables in several SQLite files are whole."""

    def __init__(self, options, read_only: bool, split: bool = True):
        self.module = importlib.import_module(options["module"])
        self.is_sqlite = self.module.__name__ == "sqlite3"
        # Only SQLite opens a database for reading; over other drivers a reading connection refuses other statements.
        self.guarded = read_only and not self.is_sqlite
        database = options["database"]
        if self.is_sqlite:
            wait = float(options.get("timeout", "60")) if read_only else WRITE_WAIT_SECONDS
            if database == ":memory:":
                self.raw = self.module.connect(database, timeout=wait, isolation_level=None)
            else:
                mode = "ro" if read_only else "rwc"
                self.raw = self.module.connect(f"file:{quote(database)}?mode={mode}", uri=True, timeout=wait,
                                               isolation_level=None)
        else:
            # true and false are flags to a driver
            arguments = {key.split(".", 1)[1]: {"true": True, "false": False}.get(value.lower(), value)
                         for key, value in options.items() if key.startswith("connect.")}
            if options.get("login_timeout_property"):
                arguments[options["login_timeout_property"]] = int(options["timeout"])
            elif int(options.get("timeout", DEFAULT_TIMEOUT)) != DEFAULT_TIMEOUT:
                raise ExternalError(f"The login timeout of {options['module']} has no known name; register the "
                                    "connection with login_timeout_property")
            if options.get("username"):
                arguments.update(user=options["username"], password=options.get("password", ""))
            self.raw = self.module.connect(database, **arguments)
        self.parts = attach(self.raw, database) if self.is_sqlite and split and database != ":memory:" else {}
        if options.get("session_init"):
            self.cursor(options["session_init"]).close()

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.raw.close()

    def begin(self):
        if self.is_sqlite:
            self.raw.execute("BEGIN IMMEDIATE")

    def commit(self):
        if self.raw.in_transaction if self.is_sqlite else True:
            self.raw.commit()

    def rollback(self):
        self.raw.rollback()

    def cursor(self, sql: str, values=()):
        made = self.raw.cursor()
        made.execute(sql, list(values)) if values else made.execute(sql)
        return made

    def run(self, sql: str, values=()):
        if self.guarded and not _READS.match(sql):
            raise ExternalError("The connection is read-only")
        self.cursor(sql, values).close()

    def run_many(self, sql: str, rows):
        made = self.raw.cursor()
        made.executemany(sql, rows)
        made.close()

    def marks(self, count: int) -> str:
        """Markers for values, in the driver's own style."""
        style = self.module.paramstyle
        one = {"qmark": "?", "format": "%s", "pyformat": "%s"}.get(style)
        return ", ".join([one] * count if one else [f":{n}" for n in range(1, count + 1)])

    def bound_name(self, name: str) -> str:
        """A quoted name for a text with markers."""
        return quoted(name).replace("%", "%%") if self.module.paramstyle in ("format", "pyformat") else quoted(name)


def stored(value):
    """A filter value as SQLite keeps it: timestamps and dates as ISO text, decimals as text."""
    if hasattr(value, "isoformat"):
        return value.isoformat(sep=" ", timespec="microseconds") if hasattr(value, "hour") else value.isoformat()
    return str(value) if isinstance(value, Decimal) else value


def describe(session: Session, relation: str, look=None) -> T.StructType:
    """Column names and Spark types of a table, view or parenthesised query, without reading its rows.

    SQLite keeps declared types only for plain columns; a computed one is typed by the kinds of all its values, which
    the database looks at. Kinds that have no common number are read as text. ``look`` finds the kinds of some columns
    in another way than by one statement: a list like that of ``kinds_of`` for each range of rows.
    """
    if not session.is_sqlite:
        return _describe_generic(session, relation)
    view = quoted(f"cf_describe_{uuid.uuid4().hex[:8]}")
    session.run(f"CREATE TEMP VIEW {view} AS SELECT * FROM {relation}")
    try:
        columns = session.cursor("SELECT name, type FROM pragma_table_info(?)", [view.strip('"')]).fetchall()
        names = [name for name, declared in columns if not declared]
        computed = merged_types(names, look(names) if look and names else [kinds_of(session, relation, names)])
        fields = [_field(name, declared or computed[name]) for name, declared in columns]
    finally:
        session.run(f"DROP VIEW {view}")
    return T.StructType(fields)


KINDS = ("integer", "real", "blob", "text")


def kinds_of(session: Session, relation: str, names: list[str], predicate: str = "") -> list[tuple]:
    """For each column whether it has integers, reals, bytes and text, and its smallest and largest integer; one pass."""
    found = []
    for start in range(0, len(names), 300):  # a statement returns 2,000 columns at most
        part = names[start:start + 300]
        listing = ", ".join(
            [f"MAX(typeof({quoted(name)}) = '{kind}')" for name in part for kind in KINDS]
            + [f"{end}(CASE WHEN typeof({quoted(name)}) = 'integer' THEN {quoted(name)} END)" for name in part for end in ("MIN", "MAX")])
        test = f" WHERE {predicate}" if predicate else ""
        row = session.cursor(f"SELECT {listing} FROM {relation}{test}").fetchone()
        found += [(*row[4 * n:4 * n + 4], *row[4 * len(part) + 2 * n:][:2]) for n in range(len(part))]
    return found


def merged_types(names: list[str], ranges: list[list[tuple]]) -> dict[str, str]:
    """Types of computed columns by the kinds of their values in all ranges of rows."""
    types = {}
    for name, rows in zip(names, zip(*ranges)):
        seen = {kind for row in rows for kind, flag in zip(KINDS, row) if flag}
        ends = [end for row in rows for end in row[4:] if end is not None]
        if seen == {"integer", "real"} and max(abs(end) for end in ends) <= 2**53:
            seen = {"real"}
        types[name] = {"integer": "bigint", "real": "double", "blob": "blob"}.get("".join(seen), "text")
    return types


def kinds_in_range(options: dict, relation: str, names: list[str], predicate: str) -> list[tuple]:
    with Session(options, read_only=True) as session:
        return kinds_of(session, relation, names, predicate)


def _describe_generic(session: Session, relation: str) -> T.StructType:
    """The types the driver names; failing that, by the PEP 249 type objects and the precision and scale it gives.

    Numbers of unknown precision are read as text, which holds all of them.
    """
    cursor = session.cursor(f"SELECT * FROM {relation} WHERE 1 = 0")
    fields = []
    for name, code, _, _, precision, scale, *_ in cursor.description:
        kind = str(getattr(code, "name", code))
        if base_name(kind) not in NAMED_TYPES:
            kind = "text"
            for constant, declared in (("BINARY", "blob"), ("DATETIME", "timestamp"), ("NUMBER", "number")):
                if getattr(session.module, constant, None) == code:
                    kind = declared
                    break
            if kind == "number":
                kind = f"decimal({precision},{scale or 0})" if precision and precision <= MAX_PRECISION else "text"
        fields.append(_field(name, kind))
    return T.StructType(fields)


def _field(name: str, declared: str) -> T.StructField:
    return T.StructField(name, spark_type(declared), True, {"remoteType": base_name(declared)})


@dataclass
class Slice(InputPartition):
    predicate: str


class DbApiReader(DataSourceReader):
    def __init__(self, options, schema: T.StructType):
        self.options = {key.lower(): value for key, value in dict(options).items()}
        self.schema = schema

    def partitions(self):
        if "predicates" in self.options:
            return [Slice(predicate) for predicate in json.loads(self.options["predicates"])]
        column = self.options.get("partitioncolumn")
        if not column:
            return [Slice("")]
        axis = axis_of(int(self.options["lowerbound"]), int(self.options["upperbound"]), str)
        count = int(self.options["numpartitions"])
        return [Slice(predicate) for predicate in range_predicates(quoted(column), axis, count)]

    def read(self, partition: Slice):
        columns = ", ".join(quoted(name) for name in self.schema.names) or "NULL"
        tests = [f"({partition.predicate})"] if partition.predicate else []
        sql = f"SELECT {columns} FROM {relation_of(self.options)}"
        if tests:
            sql += " WHERE " + " AND ".join(tests)
        types = [to_arrow_type(field.dataType) for field in self.schema]
        arrow = pa.schema([(field.name, kind) for field, kind in zip(self.schema, types)])
        wide = [place for place, kind in enumerate(types) if pa.types.is_string(kind) or pa.types.is_binary(kind)]
        size = int(self.options.get("fetchsize", FETCH_SIZE))
        with Session(self.options, read_only=self.options.get("read_only", "true") == "true") as session:
            for rows in bounded_rows(session.cursor(sql), size, STEP_ROWS if wide and session.is_sqlite else size, wide):
                arrays = [arrow_column(list(cells), kind) for cells, kind in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)


def bounded_rows(cursor, size: int, step: int, wide: list[int]):
    """Rows in lists of ``size`` at most, of about ``BATCH_BYTES`` in the columns at the places ``wide``.

    ``step`` rows are fetched at a time, fewer once a step alone was larger.
    """
    held, held_bytes, step = [], 0, min(step, size)
    while rows := cursor.fetchmany(min(step, size - len(held))):
        weight = sum(_weight([row[place] for row in rows]) for place in wide)
        held.extend(rows)
        held_bytes += weight
        if weight > BATCH_BYTES:
            step = max(1, len(rows) * BATCH_BYTES // weight)
        if len(held) >= size or held_bytes >= BATCH_BYTES:
            yield held
            held, held_bytes = [], 0
    if held:
        yield held


def _weight(cells: list) -> int:
    try:
        return sum(map(len, filter(None, cells)))
    except TypeError:  # SQLite keeps numbers in any column
        return sum(len(cell) for cell in cells if isinstance(cell, (str, bytes)))


def relation_of(options) -> str:
    """What a reader reads: the text of ``relation`` as it is, a ``table``, or the result of a ``query``."""
    if options.get("relation"):
        return options["relation"]
    if options.get("table"):
        table = quoted(options["table"])
        return f"(SELECT * FROM {table} WHERE {options['condition']}\n) cf_scan" if options.get("condition") else table
    if options.get("query"):
        return f"({options['query'].strip().rstrip(';')}\n) cf_query"
    raise ExternalError("Missing required option 'table' or 'query'")


def arrow_column(cells: list, kind: pa.DataType) -> pa.Array:
    """Database cells as one Arrow column; text that stands for a time, a date or a decimal is converted."""
    sample = next((cell for cell in cells if cell is not None), None)
    if pa.types.is_boolean(kind):
        return pa.array([None if cell is None else int(cell) != 0 for cell in cells], kind)
    if pa.types.is_string(kind):
        return pa.array([cell if cell is None or isinstance(cell, str) else str(cell) for cell in cells], kind)
    if isinstance(sample, str) and not pa.types.is_binary(kind):
        return pa.array(cells, pa.string()).cast(kind)
    if pa.types.is_integer(kind):
        wrong = next((cell for cell in cells if isinstance(cell, (float, Decimal)) and cell != int(cell)), None)
        if wrong is not None:
            raise ExternalError(f"{wrong} is no whole number, although its column is declared as one")
    if pa.types.is_decimal(kind):
        return pa.array([None if cell is None else Decimal(str(cell)) for cell in cells], kind)
    return pa.array(cells, kind)


@dataclass
class Written(WriterCommitMessage):
    tag: str
    rows: int
    number: int = 0


class DbApiWriter(DataSourceArrowWriter):
    """Insert into ``staging`` in batches, then move the accepted rows to ``target`` in one transaction."""

    def __init__(self, options, schema: T.StructType):
        self.options = dict(options)
        self.schema = schema
        self.names = [quoted(name) for name in schema.names]

    def write(self, iterator):
        tag = uuid.uuid4().hex
        size = int(self.options.get("batchsize", FETCH_SIZE))
        done = 0
        with Session(self.options, read_only=False, split=False) as session:
            names = ", ".join([*map(session.bound_name, self.schema.names), TAG_COLUMN])
            staging = self.options["staging"]
            staging = staging.replace("%", "%%") if "%%" in session.bound_name("%") else staging
            sql = f"INSERT INTO {staging} ({names}) VALUES ({session.marks(len(self.names) + 1)})"
            for batch in iterator:
                for part in pieces(batch, size):
                    cells = [database_cells(column) for column in part.columns]
                    session.begin()
                    session.run_many(sql, zip(*cells, [tag] * part.num_rows))
                    session.commit()
                done += batch.num_rows
        return Written(tag, done)

    def commit(self, messages):
        staging, target = self.options["staging"], self.options["target"]
        listing = ", ".join(self.names)
        accepted = quoted(f"cf_accepted_{uuid.uuid4().hex[:12]}")
        with Session(self.options, read_only=False, split=False) as session:
            session.begin()
            try:
                for statement in json.loads(self.options.get("before", "[]")):
                    session.run(statement)
                session.run(f"CREATE TABLE {accepted} (tag VARCHAR(32))")
                session.run_many(f"INSERT INTO {accepted} (tag) VALUES ({session.marks(1)})", [[m.tag] for m in messages if m])
                session.run(f"INSERT INTO {target} ({listing}) SELECT {listing} FROM {staging} "
                            f"WHERE {TAG_COLUMN} IN (SELECT tag FROM {accepted})")
                session.run(f"DROP TABLE {accepted}")
                session.run(f"DROP TABLE {staging}")
                for statement in json.loads(self.options.get("after", "[]")):
                    session.run(statement)
                session.commit()
            except Exception:
                session.rollback()
                raise

    def abort(self, messages):
        """Leave the target as it is. The caller drops the staging table, once no task can write to it."""


class PartsWriter(DbApiWriter):
    """Every task writes a table in a file of its own; the commit lists the tables of the accepted tasks."""

    def write(self, iterator):
        number = TaskContext.get().partitionId()
        table = f"{self.options['load']}_{uuid.uuid4().hex}"
        sql = f"INSERT INTO {quoted(table)} ({', '.join(self.names)}) VALUES ({', '.join('?' * len(self.names))})"
        done, open_rows, session = 0, 0, None
        try:
            for batch in iterator:
                for part in pieces(batch, int(self.options.get("batchsize", FETCH_SIZE))):
                    if session is None:
                        session = self._opened(number, table)
                    if not open_rows:
                        session.begin()
                    session.run_many(sql, zip(*[database_cells(column) for column in part.columns]))
                    done, open_rows = done + part.num_rows, open_rows + part.num_rows
                    if open_rows >= PART_ROWS:
                        session.commit()
                        open_rows = 0
            if session is not None:
                session.commit()
                session.run(f"CREATE INDEX {quoted(table + '_order')} ON {quoted(table)} ({self.options['ordered']})")
                session.commit()
        finally:
            if session is not None:
                session.raw.close()
        return Written(table, done, number)

    def _opened(self, number: int, table: str) -> Session:
        path = file_of(self.options["database"], f"part{number}")
        session = Session(self.options | {"database": path}, read_only=False, split=False)
        session.run(f"PRAGMA cache_size = -{PART_CACHE_KB}")
        session.run(f"CREATE TABLE {quoted(table)} {self.options['columns']}")
        return session

    def commit(self, messages):
        order = "\n".join(json.loads(self.options["split"]))
        listed = [[self.options["relation"], m.number, f"part{m.number}", m.tag, m.rows, order] for m in messages
                  if m and m.rows]
        with Session(self.options, read_only=False, split=False) as session:
            session.begin()
            try:
                session.run(CREATE_CATALOGUE)
                for statement in json.loads(self.options["before"]):
                    session.run(statement)
                session.run(f"DELETE FROM {CATALOGUE} WHERE relation = ?", [self.options["relation"]])
                session.run_many(f"INSERT INTO {CATALOGUE} VALUES (?, ?, ?, ?, ?, ?)", listed)
                for statement in json.loads(self.options["after"]):
                    session.run(statement)
                session.commit()
            except Exception:
                session.rollback()
                raise


def pieces(batch: pa.RecordBatch, rows: int):
    """A batch in pieces of so many rows at most, and of about ``PIECE_BYTES``."""
    size = max(1, min(rows, batch.num_rows * PIECE_BYTES // max(1, batch.nbytes)))
    for start in range(0, batch.num_rows, size):
        yield batch.slice(start, size)


def database_cells(column: pa.Array) -> list:
    """An Arrow column as values any driver can bind: times and decimals as text, flags as 0 or 1."""
    kind = column.type
    if pa.types.is_boolean(kind):
        return [None if cell is None else int(cell) for cell in column.to_pylist()]
    if pa.types.is_decimal(kind) or pa.types.is_date(kind) or pa.types.is_timestamp(kind):
        return column.cast(pa.timestamp("us")).cast(pa.string()).to_pylist() if pa.types.is_timestamp(kind) \
            else column.cast(pa.string()).to_pylist()
    return column.to_pylist()


class DbApiSource(DataSource):
    """``USING crossfeed_dbapi OPTIONS (module '...', database '...', table '...' | query '...')``.

    ``condition`` is a test that the database makes on the rows of a ``table``. ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions`` cut by an integer column, as they do for Spark's JDBC source.
    """

    @classmethod
    def name(cls):
        return SOURCE_NAME

    def schema(self):
        with Session(self.options, read_only=True) as session:
            return describe(session, relation_of(self.options))

    def reader(self, schema):
        return DbApiReader(self.options, schema)

    def writer(self, schema, overwrite):
        options = {key.lower(): value for key, value in dict(self.options).items()}
        return PartsWriter(options, schema) if "split" in options else DbApiWriter(options, schema)
