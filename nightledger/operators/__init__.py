"""Warehouse operators: each is ``DataFrame -> DataFrame``."""
