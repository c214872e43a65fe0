"""Shared storage, as the rest of the library uses it."""

from ..sources.shared import discard, kept_with, partitions, written

__all__ = ["discard", "kept_with", "partitions", "written"]
