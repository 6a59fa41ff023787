"""All registered queries, by name."""

from . import cleaning, files, governed, marts, profiles, rules, streams, views  # noqa: F401
from .registry import REGISTRY

__all__ = ["REGISTRY"]
