"""hourwise: hourly sensor-reading analytics expressed as Spark DataFrame / SQL / ML jobs.

Layout
------
sources/    readers, writers, schema gates and the test-data adapters
functions/  pure column expressions (no jobs)
operators/  DataFrame -> DataFrame operators (cleaning, features, analytics,
            time series, evaluation, drift, rules, clustering, models, ...)
plans/      compositions of operators into the named queries
streaming/  Structured Streaming forms of the batch operators
"""

__version__ = "0.1.0"
