"""Operators of a training-data pipeline over documents, pages and conversations.

One module per operator; each is a function from DataFrames to a DataFrame.
``queries`` registers the ``opN_<name>`` queries over the given tables.
Nothing else in the library imports this subpackage.
"""
