"""DataFrame operators: joins, key statistics, series, incremental state, checks and profiling."""
