"""riskspark: wide-table cleaning, leak-free cross-validation and linear /
logistic model fitting expressed as Spark DataFrame jobs.

Sub-packages
------------
sources    readers and writers (CSV / Parquet / JSON spec / prediction sink)
functions  column-expression helpers (hash keys, dot products, losses)
operators  cleaning, profiling, splitting, scaling, moments, training, evaluation
plans      estimators / models, cross-validation, sweeps, end-to-end runs
streaming  scoring a fitted model on a streaming DataFrame
queries    the registered query catalogue and its SQL oracle
"""

__version__ = "0.1.0"
