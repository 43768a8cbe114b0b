"""Operators of a training-data pipeline over documents and pages.

Nothing else in the library imports this subpackage.  Each module holds one
operator; ``queries`` registers them with the driver's tables.
"""
