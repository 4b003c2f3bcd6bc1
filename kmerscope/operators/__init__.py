"""DataFrame -> DataFrame operators: pair joins, scoring, LSH, sampling, top-k, run logs."""
