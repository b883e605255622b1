"""DataFrame -> DataFrame operators of the medallion layers, the incremental load and reports."""
