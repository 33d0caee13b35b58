"""Operators of a training-data pipeline: classifiers, searches, joins,
filters and formatting over documents, pages, vectors and conversations.

Each module holds one operator with a general interface; ``queries`` applies
them to the driver's tables. Nothing outside this folder imports it.
"""
