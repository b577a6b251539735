"""strataflow: layered (raw -> clean -> star schema -> reports) analytics on Spark.

Every job is a plain ``DataFrame -> DataFrame`` function composed with the
public DataFrame / SQL / Structured Streaming API; Catalyst plans the work.
Time-relative logic takes ``as_of`` / ``run_ts`` parameters, never the wall clock.
"""

__version__ = "0.1.0"
