"""Operators for preparing language-model training data at corpus size.

Nothing else in the library imports this subpackage; ``queries`` registers one query for
each operator. Every operator takes any extra columns, and selects the ones it reads by name.
"""
