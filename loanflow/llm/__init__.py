"""Operators of a training-data pipeline over the tables ``documents``, ``conversations`` and ``labels``.

One module per operator; ``queries`` registers one query per operator.  Nothing
else in the library imports this subpackage.
"""
