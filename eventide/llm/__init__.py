"""Operators for preparing language-model training data.

One module per operator; ``queries.py`` binds them to the test tables.
Nothing else in the library imports this subpackage.
"""
