"""Parallaxis: sources."""
