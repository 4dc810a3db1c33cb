"""Operators for preparing training text: near copies, classifiers, licences, mixing, packing and vector search.

Nothing else in the library imports this subpackage.
"""
