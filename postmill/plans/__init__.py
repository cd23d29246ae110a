"""Whole loads: staging, merge and the store they publish to."""
