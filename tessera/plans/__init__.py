"""Composed stages and registered queries."""
