"""verdigris: labelled-image analytics expressed as Spark DataFrame operators.

Layers:
  sources/    scans and sinks (binary files, decoded images, tables, JSON)
  functions/  column expressions (labels from paths, vector helpers, image structs)
  operators/  DataFrame -> DataFrame operators (pixels, dataset prep, scaling,
              evaluation, partition profiling, training presets)
  plans/      end-to-end flows composed from operators (ingest, featurize,
              prepare, train, registry, score)
  streaming/  Structured Streaming forms of ingest and scoring
"""

__version__ = "0.1.0"

import sys as _sys

try:
    # Ship this package's functions (e.g. the pixel batch functions given to
    # mapInPandas) to Python workers by value, so executors need no install
    # of the package and no extra files.
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # pragma: no cover
    pass
