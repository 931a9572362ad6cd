"""Operators that prepare text for training language models.

Nothing else in the library imports this subpackage; `queries.py` lists what it registers.
"""
