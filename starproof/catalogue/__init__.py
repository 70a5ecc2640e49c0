"""Every operator as a runnable query over the warehouse tables, with its SQL twin."""

from starproof.catalogue import finance, quality, reporting, text, wide
from starproof.catalogue.registry import QUERIES

__all__ = ["QUERIES", "finance", "quality", "reporting", "text", "wide"]
