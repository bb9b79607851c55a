"""Ticket analytics on Spark: layered tables, additive roll-ups, serving marts."""
