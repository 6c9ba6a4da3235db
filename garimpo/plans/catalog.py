"""Imports every module that registers queries."""

from garimpo.plans import coded, gold, incremental, lake, records, reporting, silver  # noqa: F401
from garimpo.plans.registry import REGISTRY  # noqa: F401
