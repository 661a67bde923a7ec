"""Operators of a training-data pipeline: one module per operator, one registered query each.

Nothing else in the library imports this subpackage.  Tables follow one convention: an operator
reads only the columns it names, so further columns of any name are ignored (queries) or carried
through untouched (pipeline stages).
"""
