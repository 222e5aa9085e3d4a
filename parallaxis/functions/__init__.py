"""Parallaxis: functions."""
