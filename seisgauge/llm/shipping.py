"""The package for the executors' Python workers; see :mod:`seisgauge.shipping`."""

from ..shipping import ship, shipped

__all__ = ["ship", "shipped"]
