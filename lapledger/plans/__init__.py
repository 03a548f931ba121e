"""Whole jobs: the batch that makes the facts, and the reports made from them."""
