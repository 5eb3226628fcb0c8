"""Scans, schema normalisation, source records and sinks."""
