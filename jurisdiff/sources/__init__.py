"""Readers, writers and landed-file scans."""
