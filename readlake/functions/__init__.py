"""Subpackage of readlake."""
