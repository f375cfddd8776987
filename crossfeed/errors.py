"""The one error type of the package, and the checks of named arguments."""

from __future__ import annotations


class ExternalError(Exception):
    """A failure at, or on the way to, an external database."""


def failed(operation: str, cause: BaseException | str) -> ExternalError:
    """``Failed to <operation>: <driver text>``, from a Java or a Python exception."""
    return ExternalError(f"Failed to {operation}: {driver_text(cause)}")


def driver_text(cause: BaseException | str) -> str:
    """The message the driver gave, without the Java stack trace py4j appends to it."""
    java = getattr(cause, "java_exception", None)
    if java is not None:
        while java.getCause() is not None:
            java = java.getCause()
        return str(java.getMessage())
    return str(cause).split("\nJVM stacktrace:")[0].strip()


def require_text(name: str, value) -> str:
    if value is None:
        raise ExternalError(f"Missing required parameter '{name}'")
    return check_text(name, value)


def check_text(name: str, value) -> str:
    if not isinstance(value, str):
        raise ExternalError(f"Parameter '{name}' must be a string")
    return value


def check_flag(name: str, value) -> bool:
    if not isinstance(value, bool):
        raise ExternalError(f"Parameter '{name}' must be a boolean")
    return value
