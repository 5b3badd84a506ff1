"""Writes; the only functions that start jobs on purpose."""
