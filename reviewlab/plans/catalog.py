"""Imports every query module so the registry is complete."""

from reviewlab.plans import (  # noqa: F401
    cleaning, clustering, evaluation, features, models, neighbours, rules, statistics, text, workflows,
)
from reviewlab.plans.registry import ORACLE, QUERIES  # noqa: F401
