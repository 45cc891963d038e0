"""Sinks for the layer tables."""

from campaignlake.sinks.tables import start_stream, write_table

__all__ = ["start_stream", "write_table"]
