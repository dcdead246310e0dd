"""Where tables are written. Sinks start jobs, operators do not."""

from ledgerloom.sinks.dimension import DimensionStore
from ledgerloom.sinks.warehouse import Warehouse, append_to

__all__ = ["DimensionStore", "Warehouse", "append_to"]
