"""Queries over the given tables and the SQL that says the same."""

from storelens.catalog import intake, maintenance, merchandising, order_sheets, segments, stored
from storelens.catalog.registry import Catalog

CATALOG = Catalog()
for _module in (intake, merchandising, segments, order_sheets, maintenance, stored):
    _module.register(CATALOG)
