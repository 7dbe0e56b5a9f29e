"""Reusable DataFrame operators: schema handling, keys, geo lookup, sinks."""
