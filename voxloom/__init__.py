"""voxloom: a PySpark engine for tiled, multi-channel volumetric images held as DataFrames."""
