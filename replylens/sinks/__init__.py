"""Sinks: lead CSV files, snapshots and per-executive exports."""

from .writers import lead_export_frame, write_by_executive, write_lead_csv, write_messages, write_snapshot

__all__ = ["lead_export_frame", "write_by_executive", "write_lead_csv", "write_messages", "write_snapshot"]
