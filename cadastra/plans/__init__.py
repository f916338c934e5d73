"""Derivation jobs and analytic queries, composed from the operators."""
