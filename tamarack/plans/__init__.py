"""Registered queries; importing this package registers them all."""

from tamarack.plans import tabular  # noqa: F401  isort: skip
from tamarack.plans import learning, pages, profile, recommend, search  # noqa: F401
from tamarack.plans.registry import REGISTRY  # noqa: F401
