"""Canonical file paths, so ``binaryFile.path`` and ``image.origin`` compare equal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from verdigris.functions.labels import uri_path


def canonical_path(c: str | Column, encoded: bool = True) -> Column:
    """One spelling per file: ``file:///a/b%20c.png`` (``image.origin``,
    URI-encoded) and ``file:/a/b c.png`` (``binaryFile.path``, raw) both become
    ``file:/a/b c.png``.  Only encoded paths are decoded, so a file whose
    name literally contains ``%20`` keeps it."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(uri_path(col) if encoded else col, r"^file:/+", "file:/")
