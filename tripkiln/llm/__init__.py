"""Operators for preparing training data at scale.

Each module is one operator with its own general interface; ``queries`` and
the ``opN_*`` modules' thin queries apply them to the test tables.
"""
