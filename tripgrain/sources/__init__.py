"""Readers of position samples and gold watermarks."""
