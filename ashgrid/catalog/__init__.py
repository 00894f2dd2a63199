"""Registered queries, one per operator of the inventory.

Importing this package imports every catalog module, which fills the registry.
"""

from . import evaluation, jobs, learning, publishing, rasters, resume, series, serving, spatial  # noqa: F401

publishing._register_features_only()
resume.register_all()
from .registry import HEADLINE, ORACLE_SQL, QUERIES

__all__ = ["QUERIES", "ORACLE_SQL", "HEADLINE"]
