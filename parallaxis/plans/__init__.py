"""Parallaxis: plans."""
