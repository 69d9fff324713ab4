"""Operators of a training-data pipeline over document tables.

Nothing else in the package imports this subpackage; ``registry`` lists the
queries and their SQL for ``__spark_entry__.py``.
"""
