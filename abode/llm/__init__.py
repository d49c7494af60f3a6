"""Operators of a training-data pipeline over ``documents`` and ``pages``.

Nothing else in the library imports this subpackage; ``queries`` holds what
``__spark_entry__.py`` registers.
"""
