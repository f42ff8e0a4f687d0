"""The library on executors that do not have it installed."""

from __future__ import annotations

from entityloom.sources.shipping import SHIPPED, ship

__all__ = ["SHIPPED", "ship"]
