"""crashlake: a Spark-native star-schema data lake for road-accident records.

Raw CSV datasets are landed in record-bounded chunks, turned into deduplicated
dimensions with deterministic dense surrogate keys (cities, airports, weather
conditions), joined into a typed accident fact table, written as Hive-partitioned
Parquet, checked by a data-quality report and queried through marts.

Every transform is a pure ``DataFrame -> DataFrame`` function; only
``crashlake.sinks`` and ``crashlake.plans.jobs`` run Spark actions.
"""

__version__ = "0.1.0"
