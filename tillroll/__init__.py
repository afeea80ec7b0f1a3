"""tillroll: retail transaction analytics on Spark DataFrames.

Layout
------
sources/    readers and writers (star-schema adapter, CSV/Parquet with declared schemas)
functions/  column-level building blocks (money arithmetic, calendar features, buckets,
            distributed exact quantiles)
operators/  DataFrame -> DataFrame steps (dedup, imputation, capping, ranking, profiling,
            size-checked broadcast)
plans/      composites: clean, features, analyses, summaries, dashboard view, pipeline
llm/        operators for training data, an optional part that nothing else imports

Every public function takes and returns DataFrames (or Columns). Most are lazy; those that
need a small result first (row counts for a broadcast, brackets of a quantile, tables written
once to the shared scratch folder) run Spark jobs when called, which their docstrings say. No
rows are collected to the driver, only such scalars and file paths.
"""
