"""Whole batch pipelines."""
