"""Operators of a training-data pipeline (quality, dedup, archives, privacy,
tokens, mixing, URL filters). Nothing else in the library imports this
subpackage.

Conventions of every operator here: it reads only the columns it is told
to read (extra columns, whatever their names, are ignored), accepts nulls
in any of them, empty tables, repeated rows and texts of any length, and
states in its docstring what each such case gives."""
