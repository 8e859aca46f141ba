"""Customer-communications data pipelines on PySpark.

Every operator takes and returns a ``DataFrame`` and is made of built-in Spark expressions, so Catalyst
plans it and no Python runs per row.
"""
