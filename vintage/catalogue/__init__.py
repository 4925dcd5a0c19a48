"""Queries over the test tables and their SQL twins."""

from vintage.catalogue import cleaning, evaluation, files, models, profiles, serving, splits
from vintage.catalogue.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "cleaning", "evaluation", "files", "models", "profiles", "serving", "splits"]
