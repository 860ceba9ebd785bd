"""DataFrame-to-DataFrame operators: ingest, search, memory lifecycle, graph and task analytics."""
