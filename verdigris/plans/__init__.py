"""End-to-end flows composed from operators.

ingest      directory -> metadata table (file bodies never read)
featurize   directory -> features (+ rejects), one decode per image
prepare     labelled features -> balanced, indexed, split table + label map
training    fit and compare presets; one evaluation pass for all models
registry    saved pipelines + registry table (list, load, best)
score       images -> class name, index, confidence (batch and stream)
flow        all of the above in order, each step writing its table
"""
