"""Column expressions over hierarchy paths (ids from root to object, dotted)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SEPARATOR = "."


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def path_ids(path: Column | str = "path") -> Column:
    """The ids of a path as an array of bigint; an empty path has none."""
    path = _col(path)
    steps = F.when(path == "", F.array().cast("array<string>")).otherwise(F.split(path, "[.]"))
    return steps.cast("array<bigint>")


def last_step(path: Column | str = "path") -> Column:
    return F.substring_index(_col(path), SEPARATOR, -1)


def parent_path(path: Column | str = "path") -> Column:
    """The path without its last step; empty for a root."""
    path = _col(path)
    kept = F.length(path) - F.length(last_step(path)) - 1
    return F.substring(path, F.lit(1), F.greatest(kept, F.lit(0)))


def root_id(path: Column | str = "path") -> Column:
    return F.substring_index(_col(path), SEPARATOR, 1).cast("bigint")


def under(prefix: str, path: Column | str = "path", strict: bool = False) -> Column:
    """Rows whose path starts with ``prefix``.

    The plain form compares text, so ``1`` also takes ``15.…``. ``strict`` takes
    the object itself and whole steps below it.
    """
    path = _col(path)
    if strict:
        return (path == prefix) | path.startswith(prefix + SEPARATOR)
    return path.startswith(prefix)


def below(prefix: str, path: Column | str = "path") -> Column:
    """Rows strictly below the object whose path is ``prefix``."""
    return _col(path).startswith(prefix + SEPARATOR)
