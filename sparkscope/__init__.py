"""sparkscope: DataFrame operators for studying repeated popularity snapshots.

Every operator takes a ``DataFrame`` and column names and returns a
``DataFrame`` built from Spark's own expressions, so Catalyst plans it and no
row ever passes through Python.
"""
