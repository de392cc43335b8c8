"""weir: data pipelines and data-quality checks as lazy Spark plans.

Every operator takes DataFrames and returns a DataFrame. Spark jobs run in the
sinks, the jobs and step lists that write, the ``fail_fast`` switches,
``nearest_rank`` and a ``pivot`` that has to find its values.
"""
