"""DataFrames into external tables, and single statements.

The default load is all-or-nothing and survives lost executors. Tasks write to a staging table; one transaction then
moves the rows to the target. Rows carry an identity that a repeated task writes again unchanged, so a copy left by
an executor that was lost after its commit is recognised and left out.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfeed import connections
from crossfeed.admin import open_admin, scratch_name
from crossfeed.connections import Connection
from crossfeed.errors import ExternalError, failed, require_text
from crossfeed.functions.batches import in_bounded_batches
from crossfeed.functions.types import column_of, writable
from crossfeed.operators.checkpoints import checkpointed
from crossfeed.sources import parts
from crossfeed.sources.dbapi import SOURCE_NAME, TAG_COLUMN
from crossfeed.sources.scan import register_dbapi

BATCH_SIZE = 5_000
MAX_VARCHAR = 32_672
ROW_COLUMN = "cf_row"
TRY_COLUMN = "cf_try"
MODES = ("append", "overwrite")
#: Kinds that SQLite and Spark sort alike.
_ORDERED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType, T.TimestampNTZType)


@dataclass(frozen=True)
class LoadResult:
    table: str
    rows: int


def ext_exec(spark: SparkSession, *, connection=None, sql: str | None = None, username: str = "", password: str = "",
             timeout: int = connections.DEFAULT_TIMEOUT, read_only: bool = False) -> DataFrame:
    """Run one DDL or DML statement in the external database, once, now; returns one row ``Success = true``."""
    require_text("sql", sql)
    found = connections.resolve(connection, username, password, timeout, read_only)
    text = sql.strip().rstrip(";").strip()
    if not text:
        raise ExternalError("Failed to execute statement: the statement is empty")
    with open_admin(spark, found) as admin:
        admin.run(text)
    return spark.createDataFrame([(True,)], "Success boolean")


def ext_load(frame: DataFrame, *, table_name: str | None = None, connection=None, username: str = "",
             password: str = "", timeout: int = connections.DEFAULT_TIMEOUT, mode: str = "append",
             pre_sql: tuple[str, ...] = (), post_sql: tuple[str, ...] = (), atomic: bool = True,
             stable_input: bool = False, truncate: bool = False, batch_size: int = BATCH_SIZE,
             column_types: dict[str, str] | None = None, null_sentries: dict[str, object] | None = None,
             null_flags: dict[str, str] | None = None, primary_key: tuple[str, ...] = (),
             max_connections: int | None = None, schema_name: str | None = None,
             split_by: tuple[str, ...] = ()) -> LoadResult:
    """Write ``frame`` to an external table; returns the number of rows.

    ``null_sentries`` maps a column to the value that stands for NULL, ``null_flags`` maps a column to a boolean
    column that marks its NULLs. New text columns get the width of their longest value unless ``column_types`` names
    a type. ``pre_sql`` runs before; ``post_sql`` runs with the final move, in its transaction. ``mode="overwrite"``
    builds a new table and swaps it in; ``truncate=True`` keeps the table and replaces its rows.

    A JDBC load first checkpoints its input, so that a repeated task writes the same rows; ``stable_input=True``
    skips this for input that is the same on every read (files in a fixed place). ``atomic=False`` writes straight
    to the target: faster, but a failure leaves a part behind and a repeated task may leave copies.
    ``max_connections`` limits how many tasks write at a time. The table is one of ``schema_name``, or of the schema
    that plain names stand for; a table of that name in another schema is not looked at.

    ``split_by`` is for new or replaced tables of SQLite: the rows are kept in several files, in the order of these
    columns (whole numbers, text, dates or timestamps), and written by as many tasks at a time.
    """
    spark = frame.sparkSession
    require_text("table_name", table_name)
    if mode not in MODES:
        raise ExternalError(f"Parameter 'mode' must be one of {', '.join(MODES)}")
    found = connections.resolve(connection, username, password, timeout, False)
    ready = writable(with_nulls(frame, null_sentries, null_flags))
    numbered = ready.withColumn(ROW_COLUMN, F.monotonically_increasing_id())
    if found.kind == "jdbc" and atomic and not stable_input:
        # Checkpointed once, before the text is measured, so that the input is computed a single time.
        numbered = checkpointed(numbered)
        ready = numbered.drop(ROW_COLUMN)
    with open_admin(spark, found) as admin:
        for statement in pre_sql:
            admin.run(statement, "run the statement before the load")
        schema = schema_name or admin.home()
        exists = admin.exists(table_name, schema)
    fresh = not exists or (mode == "overwrite" and not truncate)
    types = text_types(ready, column_types or {}, found) if fresh else dict(column_types or {})
    plan = _Plan(spark, found, ready, table_name, exists, fresh, mode, types, primary_key, list(post_sql), batch_size,
                 max_connections, schema)
    if split_by:
        return plan.through_parts(tuple(split_by))
    if found.kind == "dbapi":
        return plan.through_dbapi()
    return plan.through_staging(numbered) if atomic else plan.straight()


def with_nulls(frame: DataFrame, sentries: dict[str, object] | None, flags: dict[str, str] | None) -> DataFrame:
    """Sentry values and flagged cells as NULL; the flag columns are dropped."""
    sentries, flags = sentries or {}, flags or {}
    for name in (*sentries, *flags, *flags.values()):
        if name not in frame.columns:
            raise ExternalError(f"Column '{name}' is not in the frame to load")
    columns = []
    for name in frame.columns:
        if name in flags.values():
            continue
        column: Column = column_of(name)
        if name in sentries:
            column = F.nullif(column, _sentry(sentries[name], frame.schema[name].dataType))
        if name in flags:
            column = F.when(~F.coalesce(column_of(flags[name]), F.lit(False)), column)
        columns.append(column.alias(name))
    return frame.select(*columns)


def _sentry(value, kind: T.DataType) -> Column:
    """A sentry in the type of its column; times go by their text, so that no time zone shifts them."""
    return F.lit(value.isoformat() if isinstance(value, dt.date) else value).cast(kind)


def text_widths(frame: DataFrame) -> dict[str, int]:
    """The length of the longest value of every text column, in UTF-16 units, found in one pass.

    Databases that count code points need no more than that.
    """
    names = [field.name for field in frame.schema if isinstance(field.dataType, T.StringType)]
    if not names:
        return {}
    row = frame.agg(*[F.max(F.octet_length(F.encode(column_of(name), "UTF-16LE")) / 2).alias(name) for name in names]).first()
    return {name: int(row[name] or 0) for name in names}


def text_types(frame: DataFrame, given: dict[str, str], found: Connection) -> dict[str, str]:
    """Declared types of text columns: what the caller named, else VARCHAR as wide as needed.

    Text too wide for VARCHAR is left out; Spark's dialect then picks the database's type for long text.
    """
    open_columns = [field.name for field in frame.schema
                    if isinstance(field.dataType, T.StringType) and field.name not in given]
    if found.kind == "dbapi":
        return {**{name: "TEXT" for name in open_columns}, **given}
    measured = text_widths(frame.select(*[column_of(name) for name in open_columns])) if open_columns else {}
    return {**{name: f"VARCHAR({max(1, width)})" for name, width in measured.items() if width <= MAX_VARCHAR}, **given}


class _Miscounted(Exception):
    """The staging table does not hold every row exactly once."""


class _Plan:
    """One load, with what is known about its target."""

    def __init__(self, spark, found, frame, table, exists, fresh, mode, types, primary_key, post_sql, batch_size,
                 max_connections, schema=None):
        self.schema = schema
        self.spark, self.found, self.frame, self.table = spark, found, frame, table
        self.exists, self.fresh, self.mode, self.types = exists, fresh, mode, types
        self.primary_key, self.post_sql, self.batch_size = primary_key, post_sql, batch_size
        self.max_connections = max_connections
        self.observed = Observation()

    def _counted(self, frame: DataFrame) -> DataFrame:
        """``frame`` in as many tasks as may write at a time, its rows counted while they are written."""
        if self.max_connections:
            frame = frame.coalesce(self.max_connections)
        return frame.observe(self.observed, F.count(F.lit(1)).alias("rows"))

    def straight(self) -> LoadResult:
        with self._admin() as admin:
            target = admin.path(self.schema, self.table)
            if self.exists and self.mode == "overwrite":
                admin.run(f"DROP TABLE {target}" if self.fresh else f"DELETE FROM {target}")
            if self.fresh:
                self._create(admin, self.table, self.frame, self.types, self.primary_key)
        self._write(self._counted(self.frame), target)
        with self._admin() as admin:
            for statement in self.post_sql:
                admin.run(statement, "run the statement after the load")
        return LoadResult(self.table, self.observed.get["rows"])

    def through_staging(self, numbered: DataFrame) -> LoadResult:
        # The same row of a repeated task has the same identity and another mark.
        rows = numbered.withColumn(TRY_COLUMN, F.java_method(F.lit("java.util.UUID"), F.lit("randomUUID")))
        staging = scratch_name(self.table)
        built = scratch_name(self.table) if self.fresh else self.table
        try:
            with self._admin() as admin:
                # Text stays in the dialect's own type here: some drivers refuse a NULL of that type in a VARCHAR.
                self._create(admin, staging, rows, {TRY_COLUMN: "VARCHAR(36)"})
                if self.fresh:
                    self._create(admin, built, self.frame, self.types, self.primary_key)
                place = admin.path(self.schema, staging)
            # The write may take hours: no connection is held open meanwhile.
            self._write(self._counted(rows), place)
            count = self.observed.get["rows"]
            with self._admin() as admin:
                self._move(admin, staging, built, count)
        except Exception:
            self._drop(staging, *([built] if self.fresh else []))
            raise
        return LoadResult(self.table, count)

    def _drop(self, *leftovers: str) -> None:
        """Remove what a failed load left; the failure itself is what the caller gets to see."""
        try:
            with self._admin() as admin:
                for name in leftovers:
                    if admin.exists(name, self.schema):
                        admin.run(f"DROP TABLE {admin.path(self.schema, name)}")
        except ExternalError as cause:
            warnings.warn(f"Tables {', '.join(leftovers)} may be left over: {cause}", stacklevel=2)

    def _admin(self):
        return open_admin(self.spark, self.found)

    def _move(self, admin, staging: str, built: str, count: int) -> None:
        """All rows from the staging table to the target, each identity once, in one transaction.

        The number of rows moved is checked before the commit. If it is off, a task Spark had given up wrote once
        more in the meantime; the second try then looks at the identities.
        """
        place, goal = admin.path(self.schema, staging), admin.path(self.schema, built)
        names = ", ".join(admin.quote(name) for name in self.frame.columns)
        row, mark = admin.quote(ROW_COLUMN), admin.quote(TRY_COLUMN)
        held, different = admin.rows(f"SELECT COUNT(*), COUNT(DISTINCT {row}) FROM {place}")[0]
        if int(different) != count:
            raise ExternalError(f"Failed to load '{self.table}': {count} rows were written, {different} arrived")
        values = ", ".join(self._assigned(admin, built, place))
        every = f"INSERT INTO {goal} ({names}) SELECT {values} FROM {place} s"
        once = f"{every} WHERE NOT EXISTS (SELECT 1 FROM {place} d WHERE d.{row} = s.{row} AND d.{mark} < s.{mark})"
        moved = 0
        for insert in (every, once) if int(held) == count else (once,):
            try:
                with admin.in_transaction("move the loaded rows to their table"):
                    if not self.fresh and self.mode == "overwrite":
                        admin.update(f"DELETE FROM {goal}")
                    moved = admin.update(insert)
                    if moved not in (count, -1):
                        raise _Miscounted
                    if self.fresh and self.exists:
                        admin.update(f"DROP TABLE {admin.path(self.schema, self.table)}")
                    if self.fresh:
                        admin.update(admin.rename_sql(built, self.table, self.schema))
                    for statement in (f"DROP TABLE {place}", *self.post_sql):
                        admin.update(statement)
                return
            except _Miscounted:
                continue
        raise ExternalError(f"Failed to load '{self.table}': {count} rows were written, {moved} would be moved")

    def _assigned(self, admin, built: str, place: str) -> list[str]:
        """Staged columns as the target takes them. Derby assigns long text to a VARCHAR only with a cast, which
        would cut it, so the lengths are compared first; other databases convert on their own and refuse."""
        if not self.found.target.startswith("jdbc:derby:"):
            return [admin.quote(name) for name in self.frame.columns]
        widths = {name: width for name, width in admin.text_widths(built, self.schema).items() if name in self.frame.columns}
        if widths:
            lengths = ", ".join(f"MAX(LENGTH({admin.quote(name)}))" for name in widths)
            for (name, width), longest in zip(widths.items(), admin.rows(f"SELECT {lengths} FROM {place}")[0]):
                if (longest or 0) > width:
                    raise ExternalError(f"Failed to load '{self.table}': a text of {longest} characters does not fit "
                                        f"into column '{name}' of {width}")
        return [f"CAST({admin.quote(name)} AS VARCHAR({widths[name]}))" if name in widths else admin.quote(name)
                for name in self.frame.columns]

    def through_dbapi(self) -> LoadResult:
        register_dbapi(self.spark)
        in_bounded_batches(self.spark)
        staging = scratch_name(self.table)
        with self._admin() as admin:
            target, place = admin.path(self.schema, self.table), admin.path(self.schema, staging)
            before = []
            if self.exists and self.mode == "overwrite":
                before.append(f"DROP TABLE {target}" if self.fresh else f"DELETE FROM {target}")
                before += admin.forgotten(self.table)
            if self.fresh:
                before.append(self._table_sql(admin, self.table, self.primary_key))
            admin.run(self._table_sql(admin, staging, (), f", {TAG_COLUMN} VARCHAR(32)"))
        options = self.found.dbapi_options() | {
            "staging": place, "target": target, "batchsize": str(self.batch_size),
            "before": json.dumps(before), "after": json.dumps(self.post_sql),
        }
        try:
            self._counted(self.frame).write.format(SOURCE_NAME).options(**options).mode("append").save()
        except Exception as cause:
            self._drop(staging)
            raise failed(f"load table '{self.table}'", cause) from cause
        return LoadResult(self.table, self.observed.get["rows"])

    def through_parts(self, split_by: tuple[str, ...]) -> LoadResult:
        """One file per task. Equal keys meet in one part, which then keeps a primary key as the table would."""
        if self.found.driver != "sqlite3" or not (self.fresh or self.mode == "overwrite"):
            raise ExternalError("Parameter 'split_by' is for new or replaced tables of SQLite")
        if self.primary_key and split_by != tuple(self.primary_key[:len(split_by)]):
            raise ExternalError("Parameter 'split_by' must be the first columns of the primary key")
        for name in split_by:
            if name not in self.frame.columns or not isinstance(self.frame.schema[name].dataType, _ORDERED):
                raise ExternalError(f"A table can't be split by '{name}'")
        register_dbapi(self.spark)
        in_bounded_batches(self.spark)
        load = f"cf_load_{uuid.uuid4().hex[:12]}"
        by = [column_of(name) for name in split_by]
        count = max(1, min(parts.file_count(), self.spark.sparkContext.defaultParallelism))
        ordered = self.frame.repartitionByRange(min(count, self.max_connections or count), *by).sortWithinPartitions(*by)
        with self._admin() as admin:
            target, before = admin.path(self.schema, self.table), []
            if self.exists:
                before.append(f"DROP TABLE {target}" if self.fresh else f"DELETE FROM {target}")
            if self.fresh:
                before.append(self._table_sql(admin, self.table, self.primary_key))
            old = admin.part_tables(self.table)
            options = self.found.dbapi_options() | {
                "split": json.dumps(split_by), "load": load, "relation": self.table, "batchsize": str(self.batch_size),
                "ordered": ", ".join(map(admin.quote, split_by)), "columns": self._columns_sql(admin, self.primary_key) if self.fresh else admin.columns_sql(self.table),
                "before": json.dumps(before), "after": json.dumps(self.post_sql),
            }
        try:
            ordered.observe(self.observed, F.count(F.lit(1)).alias("rows")).write.format(SOURCE_NAME).options(
                **options).mode("append").save()
        except Exception as cause:
            parts.clear(self.found.target, load, set())
            raise failed(f"load table '{self.table}'", cause) from cause
        with self._admin() as admin:
            parts.clear(self.found.target, load, {name for _, name in admin.part_tables(self.table)})
        for file, name in old:
            parts.drop(parts.file_of(self.found.target, file), name.replace("_", "\\_"))
        return LoadResult(self.table, self.observed.get["rows"])

    def _table_sql(self, admin, name: str, primary_key, more: str = "") -> str:
        return f"CREATE TABLE {admin.path(self.schema, name)} {self._columns_sql(admin, primary_key, more)}"

    def _columns_sql(self, admin, primary_key, more: str = "") -> str:
        columns = ", ".join(f"{admin.quote(field.name)} {self._declared(field)}" for field in self.frame.schema)
        key = f", PRIMARY KEY ({', '.join(admin.quote(one) for one in primary_key)})" if primary_key else ""
        return f"({columns}{more}{key})"

    def _declared(self, field: T.StructField) -> str:
        if field.name in self.types:
            return self.types[field.name]
        kind = field.dataType
        if isinstance(kind, T.DecimalType):
            # SQLite would turn a DECIMAL column into floating point; a name with TEXT in it keeps every digit.
            shape = f"({kind.precision}, {kind.scale})"
            return ("DECIMAL_TEXT" if self.found.driver == "sqlite3" else "DECIMAL") + shape
        names = {T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.DoubleType: "DOUBLE PRECISION",
                 T.BinaryType: "BLOB", T.DateType: "DATE"}
        return names.get(type(kind), "TIMESTAMP")

    def _create(self, admin, name: str, frame: DataFrame, types: dict[str, str], primary_key=()) -> None:
        """An empty table in the types of Spark's dialect for the database, but for the columns in ``types``."""
        self._write(frame.limit(0), admin.path(self.schema, name), types)
        if primary_key:
            for statement in primary_key_sql(admin, self.found, admin.path(self.schema, name), primary_key):
                admin.run(statement, f"add the primary key of '{name}'")

    def _write(self, frame: DataFrame, path: str, types: dict[str, str] | None = None) -> None:
        options = self.found.jdbc_options() | {"dbtable": path, "batchsize": str(self.batch_size)}
        named = {key: value for key, value in (types or {}).items() if key in frame.columns}
        if named:
            options["createTableColumnTypes"] = ", ".join(
                "`" + key.replace("`", "``") + f"` {value}" for key, value in named.items())
        try:
            frame.write.format("jdbc").options(**options).mode("append").save()
        except Exception as cause:
            raise failed(f"load table '{self.table}'", cause) from cause


def primary_key_sql(admin, found: Connection, path: str, columns: tuple[str, ...]) -> list[str]:
    names = [admin.quote(column) for column in columns]
    add = f"ALTER TABLE {path} ADD PRIMARY KEY ({', '.join(names)})"
    if found.target.startswith("jdbc:derby:"):
        return [f"ALTER TABLE {path} ALTER COLUMN {name} NOT NULL" for name in names] + [add]
    return [add]
