"""Readers: JSON lines, stored tables, seeds and generated users."""
