"""Scans, sinks and the paged-record source."""
