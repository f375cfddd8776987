"""Crossfeed: data in external databases as partitioned Spark DataFrames, and back."""

import importlib

from pyspark import cloudpickle

from crossfeed.connections import Connection, drop_connection, register_connection
from crossfeed.errors import ExternalError
from crossfeed.sinks.load import LoadResult, ext_exec, ext_load
from crossfeed.sources.attach import ext_attach
from crossfeed.sources.lookup import ext_lookup
from crossfeed.sources.scan import ext_multi_query, ext_query, ext_scan, register_dbapi

# Code that runs inside tasks travels with them, so executors need no installed copy of the package.
for _name in ("errors", "functions.remote_types", "functions.text", "sources.splits", "sources.parts", "sources.dbapi"):
    cloudpickle.register_pickle_by_value(importlib.import_module(f"crossfeed.{_name}"))

__all__ = [
    "Connection", "ExternalError", "LoadResult", "drop_connection", "ext_attach", "ext_exec", "ext_load",
    "ext_lookup", "ext_multi_query", "ext_query", "ext_scan", "register_connection", "register_dbapi",
]
