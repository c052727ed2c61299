"""Operators over corpora for training language models."""
