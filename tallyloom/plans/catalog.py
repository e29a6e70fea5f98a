"""Imports every module that registers queries."""

from importlib import import_module

MODULES = ["relational", "scalars", "features", "campaigns", "segments", "metrics", "effects", "audiences", "operations", "learning"]

for _name in MODULES:
    import_module(f"tallyloom.plans.{_name}")
