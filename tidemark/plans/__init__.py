"""Whole workflows, put together from the operators."""

from tidemark.plans.workflows import extract, land_folders, migrate, read_back

__all__ = ["extract", "land_folders", "migrate", "read_back"]
