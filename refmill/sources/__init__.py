"""Readers: workbooks, native files, listings, registry and extraction configs."""
