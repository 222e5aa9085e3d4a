"""Parallaxis: streaming."""
