"""Imports every query module, so that the registry is complete."""

from importlib import import_module

from cohortloom.plans.registry import QUERIES  # noqa: F401

FAMILIES = (
    "seed",
    "filter",
    "distribution",
    "mapping",
    "tag",
    "activity",
    "place",
    "web",
    "feature",
    "matrix",
    "sink",
)

for _family in FAMILIES:
    import_module(f"cohortloom.plans.{_family}_queries")
