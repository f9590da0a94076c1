"""Scans and sinks: ping sources, symbol text, crash pings, profile files."""
