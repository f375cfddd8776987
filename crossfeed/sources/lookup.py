"""External rows that match the keys of a relation, read without the rest of their table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfeed import connections
from crossfeed.admin import open_admin
from crossfeed.errors import ExternalError, require_text
from crossfeed.functions.types import column_of
from crossfeed.operators.checkpoints import checkpointed
from crossfeed.operators.relations import measured_size, small_side
from crossfeed.sources.scan import ext_scan
from crossfeed.sources.splits import literal

#: Different keys at most that are sent to the database, and how many of them in one statement.
KEYS, KEYS_PER_STATEMENT = 20_000, 500
#: Text keys at most: a database may take two texts for one that Spark tells apart, so they share one statement.
TEXT_KEYS = 1_000
#: Bytes of keys at most.
KEY_BYTES = 8 * 1024 * 1024

_SENT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DateType, T.BinaryType, T.StringType)


def ext_lookup(relation: DataFrame, *, on: str | None = None, table_name: str | None = None, key: str | None = None,
               how: str = "inner", stable_input: bool = False, **options) -> DataFrame:
    """``relation`` joined to the rows of an external table whose ``key`` equals its column ``on``.

    The different keys go to the database in IN lists, and only rows that have one come back (``matching_rows``). A key
    column of the same name appears once. NULL keys match nothing; ``how="left"`` keeps rows without a match. The
    relation is checkpointed, so that the keys sent are those joined; ``stable_input=True`` skips this for input that is
    the same on every read.
    """
    require_text("on", on)
    if how not in ("inner", "left"):
        raise ExternalError("Parameter 'how' must be one of inner, left")
    if on not in relation.columns:
        raise ExternalError(f"Column '{on}' is not in the relation")
    given = relation if stable_input else checkpointed(relation)
    found = matching_rows(given, on=on, table_name=table_name, key=key, **options)
    side = small_side(given) if how == "inner" else given
    if (key or on) == on:
        return side.join(found, on, how)
    return side.join(found, side[_quoted(on)] == found[_quoted(key)], how)


def matching_rows(relation: DataFrame, *, on: str, table_name: str | None = None, connection=None, key: str | None = None,
                  max_keys: int = KEYS, keys_per_statement: int = KEYS_PER_STATEMENT, splits: list[str] | None = None,
                  **options) -> DataFrame:
    """The rows of an external table whose ``key`` is a value of the relation's column ``on``; one partition per statement.

    ``splits`` are remote conditions, disjoint and covering the table, that cut every statement further, for keys with
    very many rows, and a scan of the whole table. The whole table is scanned where there are more than ``max_keys`` different keys (``TEXT_KEYS`` for
    text), where they are too long, of a kind that has no exact literal, or of another kind than the table's; rows that match nothing are then among them.
    """
    spark, key = relation.sparkSession, key or on
    predicates = None
    login = {name: options[name] for name in ("username", "password", "timeout") if name in options}
    found, kind = connections.resolve(connection, **login), relation.schema[on].dataType
    # over DB-API decimals may be kept as text, where 1.50 is not 1.5
    if isinstance(kind, _SENT) and not (found.kind == "dbapi" and isinstance(kind, T.DecimalType)):
        is_text = isinstance(kind, T.StringType)
        most = min(max_keys, TEXT_KEYS) if is_text else max_keys
        keys = relation.select(column_of(on).alias("key")).filter(F.col("key").isNotNull()).distinct()
        rows, size = measured_size(keys, most)
        if rows <= most and size <= KEY_BYTES:
            with open_admin(spark, found) as admin:
                sent = [literal(admin, row["key"]) for row in keys.sort("key").limit(most + 1).collect()]
                name = admin.quote(key)
            if None not in sent and len(sent) <= most:
                step = max(1, len(sent) if is_text else keys_per_statement)
                lists = [f"{name} IN ({', '.join(sent[at:at + step])})" for at in range(0, len(sent), step)]
                predicates = [f"({one}) AND ({split})" if split else one
                              for one in lists or ["1 = 0"] for split in splits or [""]]
    frame = ext_scan(spark, table_name=table_name, connection=connection, predicates=predicates or splits, **options)
    if predicates and key in frame.columns and _class(frame.schema[key].dataType) != _class(kind):
        # the database and Spark may compare keys of two kinds in different ways
        return ext_scan(spark, table_name=table_name, connection=connection, predicates=splits, **options)
    return frame


def _class(kind: T.DataType) -> type:
    return T.LongType if isinstance(kind, T.IntegralType) else type(kind)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
