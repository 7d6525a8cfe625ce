"""Operators for training-data pipelines over documents, pages and vectors.

Nothing else in the library imports this package; ``__spark_entry__`` adds its
queries when it can be imported. See the module docstrings for each operator's
method and for its defined results on nulls, empty input, ties and repeats.
"""
