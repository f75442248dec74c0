"""Column-level helpers: name normalisation, string standardisation, predicate folds."""
