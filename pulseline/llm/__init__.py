"""Operators for preparing language-model training data.

Each module holds one operator with its own general interface; ``catalog``
applies them to the given tables as the registered ``opN_<name>`` queries.
Nothing outside this subpackage imports it.
"""
