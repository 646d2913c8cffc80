"""Readers: raw text lines with global line numbers, delimited files, stored tables."""
