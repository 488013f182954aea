"""Operators for preparing training data: each module holds one operator
with its own interface; ``queries`` registers them over the test tables."""
