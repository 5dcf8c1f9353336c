"""Incremental forms of the stateful operators."""
