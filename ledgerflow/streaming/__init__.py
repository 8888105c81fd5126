"""Structured Streaming form of the quarantine job."""

from ledgerflow.streaming.quarantine import start_quarantine_stream

__all__ = ["start_quarantine_stream"]
