"""Scans and derived relations."""
