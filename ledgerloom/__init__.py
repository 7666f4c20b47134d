"""ledgerloom: merchant-profitability marts, their checks and event studies on Spark.

Every public function takes and returns DataFrames (or Columns) and runs no
action of its own, unless its docstring says so.
"""
