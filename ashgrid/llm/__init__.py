"""Operators for building language-model training data, as Spark jobs.

One module per operator; ``queries`` registers one query each.  Nothing else
in the library imports this subpackage.
"""
