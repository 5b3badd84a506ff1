"""Scalar column expressions; all built in, so they stay inside code generation."""
