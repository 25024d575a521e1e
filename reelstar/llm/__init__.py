"""Operators for preparing training text at corpus scale.

Each module holds one operator with a general interface; ``queries`` wraps
them as registered queries with production parameters.
"""
