"""Operators of a training-data pipeline over the tables documents, pages, benchmark and labels.

Nothing else in the library imports this subpackage. Each module holds one operator with a general
interface; ``queries`` derives the registered queries from them.
"""
