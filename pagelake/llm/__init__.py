"""Operators for preparing language-model training data.

Optional subpackage: nothing else in the library imports it.  Each module holds
one operator with a general interface; :mod:`pagelake.llm.queries` registers the
thin queries over the driver tables.
"""
