"""Operators for training-data pipelines over `documents`: one module per operator, and their registered queries.

Nothing outside this subpackage imports it.
"""
