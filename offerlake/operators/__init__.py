"""Operators: ``DataFrame -> DataFrame`` steps of the staging chain, quality controls, comparison and warehouse."""
