"""Scans: tables, delivered files, workbooks, JSON and HTML responses."""
