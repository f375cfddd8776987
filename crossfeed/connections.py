"""Named connections and inline connection strings.

A connection is given as

* a name registered with :func:`register_connection`,
* a JDBC URL (``jdbc:...``), read and written by Spark's JDBC source,
* ``dbapi:<module>:<database>``, read and written by the Python data source of this package, or
* an attribute string ``Url=jdbc:...;Driver=...;User=...;Password=...`` (a value may be held in braces).

Secrets stay in reader and writer options; they are never part of a view definition or of ``repr``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

from crossfeed.errors import ExternalError, check_flag, check_text, require_text

DEFAULT_TIMEOUT = 60

_ATTRIBUTE = re.compile(r"\s*([\w ]+?)\s*=\s*(\{[^}]*\}|[^;]*)\s*(?:;|$)")


@dataclass(frozen=True)
class Connection:
    label: str
    kind: str
    target: str = field(repr=False)
    driver: str = ""
    username: str = ""
    password: str = field(default="", repr=False)
    timeout: int = DEFAULT_TIMEOUT
    query_timeout: int = 0
    read_only: bool = True
    login_timeout_property: str = ""
    properties: tuple[tuple[str, str], ...] = field(default=(), repr=False)
    session_init: str = ""

    def jdbc_options(self) -> dict[str, str]:
        options = dict(self.properties)
        options["url"] = self.target
        options["queryTimeout"] = str(self.query_timeout)
        options["preferTimestampNTZ"] = "true"
        if self.driver:
            options["driver"] = self.driver
        if self.username:
            options["user"] = self.username
        if self.password:
            options["password"] = self.password
        if self.login_timeout_property:
            options[self.login_timeout_property] = str(self.timeout)
        if self.session_init:
            options["sessionInitStatement"] = self.session_init
        return options

    def dbapi_options(self) -> dict[str, str]:
        return {
            "module": self.driver,
            "database": self.target,
            "username": self.username,
            "password": self.password,
            "timeout": str(self.timeout),
            "read_only": str(self.read_only).lower(),
            "session_init": self.session_init,
            "login_timeout_property": self.login_timeout_property,
            **{f"connect.{key}": value for key, value in self.properties},
        }


_registry: dict[str, Connection] = {}


def register_connection(name: str, url: str, *, driver: str = "", username: str = "", password: str = "",
                        properties: dict[str, str] | None = None, session_init: str = "",
                        login_timeout_property: str = "") -> Connection:
    """Make ``url`` known as ``name``; ``properties`` are handed to the driver as they are.

    ``session_init`` is a statement every task's connection runs first. ``login_timeout_property`` is what the driver
    calls its login timeout in seconds; with it, tasks keep to ``timeout`` as the driver process does.
    """
    made = replace(
        _from_url(require_text("url", url)),
        label=require_text("name", name),
        username=username,
        password=password,
        properties=tuple(sorted((properties or {}).items())),
        session_init=session_init,
        login_timeout_property=login_timeout_property,
    )
    if driver:
        made = replace(made, driver=driver)
    _registry[name] = made
    return made


def is_registered(name: str) -> bool:
    return name in _registry


def drop_connection(name: str) -> None:
    _registry.pop(name, None)


def resolve(connection, username: str = "", password: str = "", timeout: int = DEFAULT_TIMEOUT,
            read_only: bool = True, query_timeout: int = 0) -> Connection:
    """The connection a named argument stands for, with the per-call settings applied.

    ``timeout`` limits the login, ``query_timeout`` every statement; 0 is no limit, as long scans need.
    """
    if isinstance(connection, Connection):
        found = connection
    else:
        text = require_text("connection", connection)
        if not text.strip():
            raise ExternalError("Failed to connect: the connection is empty")
        found = _lookup(text)
    for name, seconds in (("timeout", timeout), ("query_timeout", query_timeout)):
        if isinstance(seconds, bool) or not isinstance(seconds, int) or seconds < 0:
            raise ExternalError(f"Parameter '{name}' must be an integer of at least 0")
    found = replace(found, timeout=timeout, query_timeout=query_timeout,
                    read_only=check_flag("read_only", read_only))
    if check_text("username", username):
        found = replace(found, username=username)
    if check_text("password", password):
        found = replace(found, password=password)
    return found


def _lookup(text: str) -> Connection:
    if text in _registry:
        return _registry[text]
    if text.startswith(("jdbc:", "dbapi:")):
        return _from_url(text)
    if "=" in text:
        return _from_attributes(text)
    raise ExternalError(f"Failed to connect to '{text}': no connection of that name is registered")


def _from_url(url: str) -> Connection:
    if url.startswith("jdbc:derby:"):
        return Connection("jdbc:derby", "jdbc", url, driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    if url.startswith("jdbc:"):
        return Connection(":".join(url.split(":")[:2]), "jdbc", url)
    if url.startswith("dbapi:") and url.count(":") >= 2:
        _, module, database = url.split(":", 2)
        return Connection(f"dbapi:{module}", "dbapi", database, driver=module)
    raise ExternalError(f"Failed to connect to '{url.split(':')[0]}': the URL starts with neither jdbc: nor dbapi:")


def _from_attributes(text: str) -> Connection:
    given = {key.lower(): value.strip("{}") for key, value in _ATTRIBUTE.findall(text)}
    url = given.pop("url", "")
    if not url:
        raise ExternalError("Failed to connect: the connection string has no Url attribute")
    made = _from_url(url)
    driver = given.pop("driver", made.driver)
    username = given.pop("user", given.pop("uid", ""))
    password = given.pop("password", given.pop("pwd", ""))
    return replace(made, driver=driver, username=username, password=password,
                   properties=tuple(sorted(given.items())))
