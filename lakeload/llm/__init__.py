"""Operators for preparing training data: texts in, decisions, ids, files and scores out.

Each module holds one operator with its own interface; :mod:`lakeload.llm.queries` applies them to
the given tables. Nothing else in the library imports this subpackage.
"""
