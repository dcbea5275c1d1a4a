"""Relational operators: DataFrame in, DataFrame out; keys are columns."""
