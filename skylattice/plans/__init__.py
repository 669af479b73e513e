"""Registered queries, their SQL oracles, derived fixtures, and the seven public point functions."""
