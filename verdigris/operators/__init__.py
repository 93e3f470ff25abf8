"""DataFrame -> DataFrame operators.

dataset     joins on derived keys, class statistics, exact balance
            (``rank_within_quota``), hash / stratified / random splits, label maps
pixels      image validation (JVM) and pixel features (NumPy over Arrow batches)
features    scaler stages for vectors, ``UnitClip``, ``scale_columns`` for table columns
train       classifier presets and the [min-max, (clip), standard, classifier] pipeline
evaluate    confusion cells -> per-class and weighted metrics, best model
decode      class index -> name (size-checked broadcast), confidence
partitions  ``keyed_partitions``, partition profile, small-data guard, partition sweep
"""
