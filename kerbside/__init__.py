"""kerbside: streaming and lap analytics expressed as Spark DataFrame transforms.

Sub-packages
------------
sources    table loaders, message-envelope stream readers, fixture projections
functions  column-expression helpers (parsing, ids, ISO rendering, null-safe casts)
operators  DataFrame -> DataFrame transforms (alerts, windows, laps, graph, serve, quality)
plans      the registered query catalogue shared by tests, bench and the SQL oracle
streaming  Structured Streaming jobs (bronze landing, alert stream, windowed analytics, gold)
"""

__all__ = ["session"]
