"""Writers: keyed merges into partitioned Parquet, the lake and its catalog."""
