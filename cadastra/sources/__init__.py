"""Readers of the publishers' formats."""
