"""Registered queries and the SQL that checks them."""

from parcelmill.registry import cdc, control, dashboards, dataset, gold, marts, security, semantic, streams  # noqa: F401
from parcelmill.registry.base import ORACLES, QUERIES  # noqa: F401
