"""DataFrame operators: lineage, aggregates, sequences, ranking, time joins, gates and kernels."""
