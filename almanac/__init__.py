"""almanac: monthly demand forecasting expressed as Spark DataFrame, SQL and MLlib work.

Sub-packages
------------
sources     table readers, run configuration, forecast sinks
operators   DataFrame -> DataFrame building blocks (filter, reshape, join, aggregate, window, encode)
functions   column-level scalar functions and the MAPE metric / evaluator
plans       end-to-end plans: monthly features, per-group models, tree models, model selection
streaming   the monthly roll-up over a file stream (same operator, incremental input)
"""

__version__ = "0.1.0"
