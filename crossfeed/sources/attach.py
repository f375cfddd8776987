"""Every table and view of an external database as a temporary view of the session."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from crossfeed import connections
from crossfeed.admin import TABLE_KINDS, VIEW_KINDS, Relation, open_admin
from crossfeed.errors import ExternalError, check_flag, check_text
from crossfeed.sources.scan import ext_scan

REPORT_SCHEMA = "name string, kind string, status string, error string"


def ext_attach(spark: SparkSession, *, connection=None, username: str = "", password: str = "",
               overwrite: bool = False, all_varchar: bool = False, encoding: str = "UTF-8",
               timeout: int = connections.DEFAULT_TIMEOUT, read_only: bool = True,
               tables_like: str | list[str] | None = None, schema_name: str | None = None,
               prefix: str = "", num_partitions: int | None = None,
               partition_columns: dict[str, str] | None = None) -> DataFrame:
    """Create one view per external table and view; returns a report with one row for each of them.

    A name that is taken is an error unless ``overwrite``. ``tables_like`` keeps names that match a LIKE pattern
    (``%``, ``_``, escape ``\\``), or one of several. An object that cannot be attached is reported and the rest goes
    on. Partitions are ranges of the primary key, or of the column that ``partition_columns`` names for a table or
    view; no rows are counted for them. The views are temporary: their options, credentials included, are stored in no catalogue.
    """
    check_flag("overwrite", overwrite)
    check_flag("all_varchar", all_varchar)
    check_text("encoding", encoding)
    found = connections.resolve(connection, username, password, timeout, read_only)
    report = []
    with open_admin(spark, found) as admin:
        listed = admin.relations(TABLE_KINDS)
        try:
            listed += admin.relations(VIEW_KINDS)
        except Exception as cause:
            report.append(("", "VIEW", "failed", f"Failed to list views: {cause}"))
    wanted = [one for one in listed if _matches(one, tables_like, schema_name)]
    homes = Counter(one.name.lower() for one in wanted)
    for one in wanted:
        if homes[one.name.lower()] > 1:
            report.append((prefix + one.name, one.kind, "failed",
                           f"'{one.name}' is in several schemas, name one by schema_name"))
    wanted = [one for one in wanted if homes[one.name.lower()] == 1]
    if not overwrite:
        taken = [one.name for one in wanted if spark.catalog.tableExists(_quoted(prefix + one.name))]
        if taken:
            raise ExternalError(f"Failed to attach: '{prefix}{taken[0]}' already exists, set overwrite to replace it")
    for one in wanted:
        try:
            frame = ext_scan(spark, table_name=one.name, schema_name=one.schema or None, connection=found,
                             timeout=timeout, read_only=read_only, all_varchar=all_varchar, encoding=encoding,
                             num_partitions=num_partitions, partition_column=(partition_columns or {}).get(one.name),
                             count_rows=False)
            create = frame.createOrReplaceTempView if overwrite else frame.createTempView
            create(_quoted(prefix + one.name))
            report.append((prefix + one.name, one.kind, "attached", None))
        except Exception as cause:
            report.append((prefix + one.name, one.kind, "failed", str(cause)))
    return spark.createDataFrame(report, REPORT_SCHEMA)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _matches(one: Relation, tables_like, schema_name) -> bool:
    if schema_name and one.schema.lower() != schema_name.lower():
        return False
    if tables_like is None:
        return True
    patterns = [tables_like] if isinstance(tables_like, str) else tables_like
    return any(like_pattern(pattern).fullmatch(one.name) for pattern in patterns)


def like_pattern(pattern: str) -> re.Pattern:
    """A LIKE pattern as a regular expression: ``%`` any text, ``_`` one character, ``\\`` takes the next as it is."""
    made, escaped = "", False
    for sign in pattern:
        if escaped or sign not in "\\%_":
            made, escaped = made + re.escape(sign), False
        elif sign == "\\":
            escaped = True
        else:
            made += ".*" if sign == "%" else "."
    return re.compile(made, re.IGNORECASE | re.DOTALL)
