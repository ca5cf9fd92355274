"""The jobs: compositions of operators from topic to topic.

Each module has functions from DataFrame to DataFrame, usable on tables, and a ``start``
that runs them on a stream.
"""
