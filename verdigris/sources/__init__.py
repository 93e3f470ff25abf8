"""Scans and sinks."""

from verdigris.sources.files import binary_files, image_files  # noqa: F401
from verdigris.sources.tables import json_rows, json_table, label_map_rows, read_table, rows_table, write_bucketed  # noqa: F401
from verdigris.sources.sinks import (  # noqa: F401
    export_results,
    write_counted,
    write_json_map,
    write_json_object,
    write_step,
    write_table,
)
