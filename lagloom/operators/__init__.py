"""DataFrame operators: lazy, distributed, without Python functions in the data path."""
