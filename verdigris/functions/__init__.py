"""Column expressions (JVM-side, codegen friendly)."""

from verdigris.functions.labels import (  # noqa: F401
    LABEL_PATTERN,
    basename,
    healthy_flag,
    label_from_name,
    label_from_parent_dir,
    normalise_name,
    uri_path,
)
from verdigris.functions.paths import canonical_path  # noqa: F401
from verdigris.functions.vectors import confidence_pct, to_array, to_vector  # noqa: F401
