"""Imports every module that registers queries."""

from waymesh.plans import catalog_exports, catalog_network, catalog_relational, catalog_repair  # noqa: F401
