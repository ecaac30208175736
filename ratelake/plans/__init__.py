"""Pipelines composed from the operators."""
