"""Schemas, feed readers and dataset readers/writers."""

from . import feeds, landing, schemas

__all__ = ["feeds", "landing", "schemas"]
