"""Scans: folders, workbooks, CSV, tables; and the per-source contracts."""
