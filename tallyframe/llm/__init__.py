"""Operators that prepare training data: each module is one operator.

Every operator takes a DataFrame with columns of any further names. Where rows of
the input come back, they are the struct ``row`` of all input columns, so no
column of the input can clash with one that the operator adds.
"""
