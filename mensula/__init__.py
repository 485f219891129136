"""Entity-by-period panel analytics as Spark DataFrame transformations."""

from mensula.panel import Panel

__all__ = ["Panel"]
