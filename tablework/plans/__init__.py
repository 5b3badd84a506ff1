"""Whole flows, from source to published table or answer."""
