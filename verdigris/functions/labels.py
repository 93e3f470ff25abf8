"""Labels and join keys derived from file paths (all built-in expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's behaviour) -------------------
# Class code after three underscores in a file name, e.g.
#   "<uuid>___RS_HL 0474.JPG" -> "RS_HL"; stops at the first character outside
#   [A-Za-z0-9_] and never ends on an underscore.
LABEL_PATTERN = r"___([A-Za-z0-9]+(?:_[A-Za-z0-9]+)*)"
# Last path segment (empty when the path ends with "/").
BASENAME_PATTERN = r"[^/]+$"
# Substring that marks a class as healthy (case-insensitive).
HEALTHY_PATTERN = "healthy"
# ---------------------------------------------------------------------------


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def uri_path(c: str | Column) -> Column:
    """Percent-decode a path (``image.origin`` is URI-encoded, ``binaryFile.path`` is not).

    Malformed escapes leave the value unchanged instead of failing the job.
    """
    c = _col(c)
    return F.coalesce(F.try_url_decode(F.regexp_replace(c, r"\+", "%2B")), c)


def basename(c: str | Column, empty_as_null: bool = False, decode: bool = False) -> Column:
    """Last path segment. ``empty_as_null`` turns the key of ``.../dir/`` into NULL
    so it can never join."""
    c = _col(c)
    if decode:
        c = uri_path(c)
    key = F.regexp_extract(c, BASENAME_PATTERN, 0)
    return F.nullif(key, F.lit("")) if empty_as_null else key


def label_from_name(c: str | Column, pattern: str = LABEL_PATTERN,
                    scope: str = "basename") -> Column:
    """First capture group of ``pattern``; no match gives NULL (never "").

    ``scope="basename"`` looks only at the file name, so a directory called
    ``X___Y`` cannot win; ``scope="path"`` scans the whole path (first match).
    """
    if scope not in ("basename", "path"):
        raise ValueError(f"scope must be 'basename' or 'path', got {scope!r}")
    target = basename(c) if scope == "basename" else _col(c)
    return F.nullif(F.regexp_extract(target, pattern, 1), F.lit(""))


def label_from_parent_dir(c: str | Column) -> Column:
    """Name of the directory that holds the file (second-to-last segment);
    NULL when the path has fewer than two segments (ANSI-safe)."""
    return F.try_element_at(F.split(_col(c), "/"), F.lit(-2))


def healthy_flag(c: str | Column, pattern: str = HEALTHY_PATTERN) -> Column:
    """True when the class name contains ``pattern``, case-insensitively."""
    return F.lower(_col(c)).contains(pattern.lower())


def normalise_name(c: str | Column) -> Column:
    """Model / class display name -> storage name (spaces become underscores)."""
    return F.replace(_col(c), F.lit(" "), F.lit("_"))


def normalise_name_py(name: str) -> str:
    return name.replace(" ", "_")
