"""The external database the registered queries read and write.

Which one it is depends on the session:

* ``spark.crossfeed.fixture.url`` set: the database the cluster has, staged into under the given URL (with
  ``.driver``, ``.user``, ``.password`` beside it);
* local mode: embedded Derby in Spark's own JVM, over JDBC, in a new temporary folder
  (``spark.crossfeed.fixture.kind=sqlite`` takes the next way instead);
* otherwise: SQLite files in the folder all executors share, over the DB-API source. A Derby database could be seen
  by its own process only.

Tables are staged once per session and data folder, when a query first asks for them.
"""

from __future__ import annotations

import hashlib
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from crossfeed import connections
from crossfeed.admin import open_admin
from crossfeed.connections import register_connection
from crossfeed.errors import ExternalError
from crossfeed.operators.checkpoints import is_local, shared_folder
from crossfeed.sinks.load import ext_exec, ext_load
from crossfeed.sources.splits import balanced_predicates

URL_SETTING = "spark.crossfeed.fixture.url"
KIND_SETTING = "spark.crossfeed.fixture.kind"

KEYS = {
    "region": ("r_regionkey",), "nation": ("n_nationkey",), "customer": ("c_custkey",), "supplier": ("s_suppkey",),
    "part": ("p_partkey",), "orders": ("o_orderkey",), "events": ("event_id",), "documents": ("doc_id",),
}
# A table without a unique key: the column it is cut by, and the column that cuts a hot key.
RANGE_COLUMNS = {"lineitem": ("l_orderkey", "l_partkey")}
#: Tables whose rows do not grow; in SQLite the others are split over files.
FEW_ROWS = ("region", "nation")
VIEWS = {
    "customer_nation": (("customer", "nation"),
                        'CREATE VIEW "customer_nation" AS SELECT c."c_custkey", c."c_name", c."c_acctbal", n."n_name", '
                        'n."n_regionkey" FROM "customer" c JOIN "nation" n ON c."c_nationkey" = n."n_nationkey"'),
}

_cuts: dict[tuple[str, str, int], list[str]] = {}
_staged: dict[tuple[str, str], set[str]] = {}
_folders: dict[str, str] = {}


def read_parquet(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def source(spark: SparkSession, sf_dir: str, *relations: str) -> str:
    """The name of a connection to the staged tables; stages those of ``relations`` that are still missing."""
    name = _connection(spark, sf_dir, "source")
    done = _staged.setdefault((spark.sparkContext.applicationId, name), set())
    for relation in relations:
        if relation in done:
            continue
        if relation in VIEWS:
            needed, sql = VIEWS[relation]
            source(spark, sf_dir, *needed)
            if not _exists(spark, name, relation):
                ext_exec(spark, connection=name, sql=sql)
        else:
            column, _ = RANGE_COLUMNS.get(relation, (None, None))
            index = (f'CREATE INDEX "{relation}_range" ON "{relation}" ("{column}")',) if column else ()
            found = connections.resolve(name)
            jdbc = found.kind == "jdbc"
            split = (RANGE_COLUMNS.get(relation) or KEYS.get(relation, ())) if found.driver == "sqlite3" else ()
            # The fixture is written by one process in local mode; a shared database gets the safe path.
            kept = _exists(spark, name, relation)
            ext_load(read_parquet(spark, sf_dir, relation), table_name=relation, connection=name, mode="overwrite",
                     primary_key=KEYS.get(relation, ()), post_sql=() if kept else index, stable_input=True,
                     truncate=kept, atomic=not (jdbc and is_local(spark)),
                     split_by=() if relation in FEW_ROWS else split)
        done.add(relation)
    return name


def balanced_cuts(spark: SparkSession, sf_dir: str, relation: str, count: int | None = None) -> list[str]:
    """Partitions with even numbers of rows for a table of ``RANGE_COLUMNS``, counted once per session."""
    name = source(spark, sf_dir, relation)
    count = count or spark.sparkContext.defaultParallelism
    key = (name, relation, count)
    if key not in _cuts:
        with open_admin(spark, connections.resolve(name)) as admin:
            _cuts[key] = balanced_predicates(admin, admin.find(relation).path, RANGE_COLUMNS[relation][0], count,
                                             RANGE_COLUMNS[relation][1])
    return _cuts[key]


def target(spark: SparkSession, sf_dir: str) -> str:
    """The name of a connection to an empty database for the load queries."""
    return _connection(spark, sf_dir, "target")


def sqlite_source(spark: SparkSession, sf_dir: str, *relations: str) -> str:
    """A second, SQLite database with the given tables, for the DB-API source."""
    name = _sqlite(spark, f"{_tag(spark, sf_dir)}-lite")
    done = _staged.setdefault((spark.sparkContext.applicationId, name), set())
    for relation in relations:
        if relation not in done:
            ext_load(read_parquet(spark, sf_dir, relation), table_name=relation, connection=name, mode="overwrite",
                     primary_key=KEYS.get(relation, ()))
            done.add(relation)
    return name


def _exists(spark: SparkSession, name: str, relation: str) -> bool:
    with open_admin(spark, connections.resolve(name, read_only=False)) as admin:
        return admin.exists(relation)


def _connection(spark: SparkSession, sf_dir: str, role: str) -> str:
    kind = spark.conf.get(KIND_SETTING, "derby")
    name = f"{_tag(spark, sf_dir)}-{kind}-{role}"
    if connections.is_registered(name):
        return name
    url = spark.conf.get(URL_SETTING, None)
    if url:
        register_connection(name, url, driver=spark.conf.get("spark.crossfeed.fixture.driver", ""),
                            username=spark.conf.get("spark.crossfeed.fixture.user", ""),
                            password=spark.conf.get("spark.crossfeed.fixture.password", ""))
        return name
    if is_local(spark) and kind == "derby":
        settings = spark._jvm.java.lang.System
        folder = _folder(spark)
        settings.setProperty("derby.stream.error.file", f"{folder}/derby.log")
        settings.setProperty("derby.system.durability", "test")
        heap = spark._jvm.java.lang.Runtime.getRuntime().maxMemory()
        settings.setProperty("derby.storage.pageCacheSize", str(max(1_000, min(20_000, heap // 8 // 32_768))))
        register_connection(name, f"jdbc:derby:{folder}/{name};create=true")
        return name
    return _sqlite(spark, name)


def _sqlite(spark: SparkSession, name: str) -> str:
    if not connections.is_registered(name):
        register_connection(name, f"dbapi:sqlite3:{_folder(spark)}/{name}.sqlite")
    return name


def _folder(spark: SparkSession) -> str:
    """A new folder for this application below the one all executors share; in local mode a temporary one may do."""
    application = spark.sparkContext.applicationId
    if application not in _folders:
        shared = re.sub("^file:(//)?", "", shared_folder(spark))
        if "://" in shared and is_local(spark):
            shared = tempfile.gettempdir()
        if "://" in shared:
            raise ExternalError(f"SQLite needs a mounted folder; set {URL_SETTING} to a database instead")
        made = f"{shared}/crossfeed-{application}-{uuid.uuid4().hex[:8]}"
        os.makedirs(made)
        _folders[application] = made
    return _folders[application]


def _tag(spark: SparkSession, sf_dir: str) -> str:
    return "cf" + hashlib.sha1(f"{spark.sparkContext.applicationId}|{os.path.abspath(sf_dir)}".encode()).hexdigest()[:10]
