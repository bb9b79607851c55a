"""Operators for training data: each module is one operator with its own general interface.

`queries` holds the registered query of each operator. Nothing else in the package imports this
subpackage.
"""
