"""panelworks: DataFrame operators and batch jobs for panel data on Spark."""

from panelworks.panel import Panel

__all__ = ["Panel"]
