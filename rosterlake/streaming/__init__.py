"""Incremental landing: every delivered file is processed once."""
