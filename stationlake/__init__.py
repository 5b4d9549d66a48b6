"""stationlake: daily station-observation analytics as Spark DataFrame / SQL jobs.

Layout
  sources/    readers and writers: fixed-width month records, by-station CSV,
              reanalysis JSON, dimensions, staged/parquet sinks
  functions/  column expressions (units, date keys, calendar parts, flags)
  operators/  conform, quality audits, views, series, EDA, features, models,
              forecasts -- each a function DataFrame -> DataFrame
  plans/      the test bindings on the driver's tables and the query registry

Every operator keys on ``station_id`` and never pulls rows to the driver.
"""

import sys

from pyspark import cloudpickle

# Functions of this package that run in Python workers (the grouped forecast, the
# linear solve) are shipped by value, so executors need pyspark, numpy and pandas
# but not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from stationlake.session import get_spark, shared_dir  # noqa: E402

__all__ = ["get_spark", "shared_dir"]
