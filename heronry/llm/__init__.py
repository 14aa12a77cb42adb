"""Operators for building language-model training corpora.

Each module holds one operator with a general interface; ``queries`` binds
them to the test tables. Nothing outside this folder imports it.
"""
