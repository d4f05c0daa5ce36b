"""tessera: PySpark-native star-schema analytics.

Flat, messy records -> tolerant cleaning -> dimensions, facts and bridges with
stable surrogate keys -> data-quality checks returned as tables -> summary
marts and wide star joins -> column profiling -> distributed hypothesis tests
and distribution summaries.

Every operator is a plain function over DataFrames built from Spark's own
expressions; only small, bounded results (pivot values, a few offending keys,
range ids) ever reach the driver.

Layout:
    sources/    readers, SQL entry points, schemas, full-refresh writer
    functions/  column expressions (cleaning, parsing, calendar, p-values)
    operators/  DataFrame -> DataFrame operators (filters, model, quality,
                marts, statistics; ranking/quantiles/staging for skew-safe
                exact positions)
    plans/      configurations: the mission ETL and the driver-table bindings
"""

__version__ = "0.1.0"
