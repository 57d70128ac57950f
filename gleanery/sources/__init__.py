"""Scans, table reads and file manifests."""
