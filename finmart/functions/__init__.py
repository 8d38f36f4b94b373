"""Scalar ``Column -> Column`` functions; all compose built-ins, none is a Python UDF."""
