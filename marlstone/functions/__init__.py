"""Scalar functions as Columns; Arrow-batched Python only where Spark has no equal."""
