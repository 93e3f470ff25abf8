"""Directory scans: raw bytes (``binaryFile``) and decoded pixels (``image``).

Both are Spark's own file sources, so listing, splitting and retry are the
cluster's.  Pruning ``content`` (metadata-only flows) means file bodies are
never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BINARY_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])

IMAGE_FIELDS = T.StructType([
    T.StructField("origin", T.StringType(), True),
    T.StructField("height", T.IntegerType(), True),
    T.StructField("width", T.IntegerType(), True),
    T.StructField("nChannels", T.IntegerType(), True),
    T.StructField("mode", T.IntegerType(), True),
    T.StructField("data", T.BinaryType(), True),
])
IMAGE_SCHEMA = T.StructType([T.StructField("image", IMAGE_FIELDS, True)])


def _file_options(reader, glob: str | None, recursive: bool,
                  modified_after: str | None, modified_before: str | None):
    reader = reader.option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    if modified_before:
        reader = reader.option("modifiedBefore", modified_before)
    return reader


def binary_files(spark: SparkSession, path: str, glob: str | None = None,
                 recursive: bool = True, modified_after: str | None = None,
                 modified_before: str | None = None) -> DataFrame:
    """All files under ``path`` as ``path, modificationTime, length, content``.

    Select without ``content`` to list metadata only (the source then skips
    reading file bodies)."""
    reader = _file_options(spark.read.format("binaryFile"), glob, recursive,
                           modified_after, modified_before)
    return reader.load(path)


def image_files(spark: SparkSession, path: str, glob: str | None = None,
                recursive: bool = True, drop_invalid: bool = False) -> DataFrame:
    """Decoded images (JVM decoder) as ``image struct<origin,height,width,
    nChannels,mode,data>``; pixel bytes are BGR(A), row-major.

    With ``drop_invalid=False`` unreadable files stay as rows with
    ``height = -1`` so they can be counted in a rejects table."""
    reader = _file_options(spark.read.format("image"), glob, recursive, None, None)
    return reader.option("dropInvalid", str(drop_invalid).lower()).load(path)
