"""Operators of a training-data pipeline over ``documents``, ``benchmark``, ``labels`` and ``conversations``.

Each module holds one operator; ``queries`` registers one thin query per operator.
Nothing outside this subpackage imports it.
"""
