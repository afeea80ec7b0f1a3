"""Training-data operators on Spark: ten operators and their queries.

Nothing outside this package imports it. General helpers (scratch tables, size-checked
broadcasts) come from :mod:`tillroll.session` and :mod:`tillroll.operators.joins`.
"""
