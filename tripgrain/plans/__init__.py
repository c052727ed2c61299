"""Whole statistics and the refresh that maintains them."""
