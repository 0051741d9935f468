"""Operators for preparing training data at scale.

Nothing else in the package imports this one. Every operator reads only the columns it
is told about, so further columns, whatever their names, never collide with its own.
"""
