"""SQLite tables that are kept in several files, so that as many tasks can write at a time.

SQLite takes one writer per file. A load that is split writes one file per task, ``<database>-part<n>``, each with a table
of that task's rows, and then lists the tables of the accepted tasks in ``cf_parts`` of the database, in one transaction.
Whoever opens the database finds a temporary view of the table's name over the table itself and all its parts, and any
statement works on it. A connection takes ``FILES`` further files at most; a file holds parts of any number of tables.

The parts follow one another in the order of the columns the load was split by, and so do the rows of each part. The key
at any place in that order is then found by row number, without counting or sorting.
"""

from __future__ import annotations

import os
import sqlite3
from dataclasses import dataclass
from itertools import groupby
from urllib.parse import quote

CATALOGUE = "cf_parts"
#: Files that SQLite attaches to a connection, unless it was built for more or fewer.
FILES = 10

CREATE_CATALOGUE = (f"CREATE TABLE IF NOT EXISTS {CATALOGUE} (relation TEXT, number INTEGER, file TEXT, stored TEXT, "
                    "n_rows INTEGER, ordered TEXT)")


@dataclass(frozen=True)
class Parts:
    """The parts of a table in their order: its columns, and for each part its path and number of rows."""

    order: tuple[str, ...]
    tables: tuple[tuple[str, int], ...]


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def file_of(database: str, file: str) -> str:
    return f"{database}-{file}"


def file_count() -> int:
    """Files that a connection can attach."""
    probe = sqlite3.connect(":memory:")
    try:
        return max(1, min(FILES, probe.getlimit(sqlite3.SQLITE_LIMIT_ATTACHED)))
    finally:
        probe.close()


def has_catalogue(raw) -> bool:
    return raw.execute("SELECT 1 FROM main.sqlite_master WHERE name = ?", [CATALOGUE]).fetchone() is not None


def attach(raw, database: str) -> dict[str, Parts]:
    """Attach the files of a database and put views over the split tables; what is split, by quoted name.

    The database's own views are repeated as temporary ones, since only these see other files.
    """
    if not has_catalogue(raw):
        return {}
    listed = raw.execute(f"SELECT relation, file, stored, n_rows, ordered FROM main.{CATALOGUE} "
                         "ORDER BY relation, number").fetchall()
    places: dict[str, str] = {}
    for _, file, *_ in listed:
        if file not in places:
            places[file] = f"cf_file_{len(places)}"
            raw.execute(f"ATTACH ? AS {places[file]}", [f"file:{quote(file_of(database, file))}?mode=ro"])
    found = {}
    for relation, group in groupby(listed, lambda row: row[0]):
        rows = list(group)
        tables = tuple((f"{places[file]}.{quoted(stored)}", n) for _, file, stored, n, _ in rows)
        every = " UNION ALL ".join(f"SELECT * FROM {path}" for path in [f"main.{quoted(relation)}", *(t for t, _ in tables)])
        raw.execute(f"CREATE TEMP VIEW {quoted(relation)} AS {every}")
        found[quoted(relation)] = Parts(tuple(rows[0][4].split("\n")), tables)
    if found:
        for (sql,) in raw.execute("SELECT sql FROM main.sqlite_master WHERE type = 'view'").fetchall():
            raw.execute("CREATE TEMP VIEW" + sql[len("CREATE VIEW"):])
    return found


def clear(database: str, load: str, kept: set[str]) -> None:
    """Drop what a load left in the files beside the parts that were kept."""
    for number in range(file_count()):
        path = file_of(database, f"part{number}")
        if os.path.exists(path):
            drop(path, load + "\\_%", kept)


def drop(path: str, like: str, kept: set[str] = frozenset()) -> None:
    """Drop the tables of a file whose names are like a pattern, but for some."""
    raw = sqlite3.connect(path, timeout=60, isolation_level=None)
    try:
        names = raw.execute("SELECT name FROM sqlite_master WHERE type = 'table' AND name LIKE ? ESCAPE '\\'", [like])
        for (name,) in names.fetchall():
            if name not in kept:
                raw.execute(f"DROP TABLE {quoted(name)}")
    finally:
        raw.close()
