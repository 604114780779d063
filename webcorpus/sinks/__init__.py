"""Sinks: chunk records and run logs."""
