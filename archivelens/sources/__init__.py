"""Scans, fixtures and providers."""
