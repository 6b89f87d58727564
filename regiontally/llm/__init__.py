"""Operators for preparing large text corpora: one module per operator.

Nothing outside this package imports it. Every operator is a Spark job: the
driver only ever holds values of a fixed, documented size.
"""
