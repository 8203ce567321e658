"""Structured Streaming forms of the incremental operators (T1-T4)."""

from .incremental import consolidate_stream, merge_leads
from .operators import (dedupe_stream, first_response_stream, open_sessions, parse_export_stream, read_export_stream,
                        run_available, session_counts)

__all__ = ["consolidate_stream", "merge_leads", "dedupe_stream", "first_response_stream", "open_sessions",
           "parse_export_stream", "read_export_stream", "run_available", "session_counts"]
