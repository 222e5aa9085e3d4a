"""Parallaxis: operators."""
