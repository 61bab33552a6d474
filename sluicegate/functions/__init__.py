"""Scalar semantics of the rule language as SQL over VARIANT values."""
