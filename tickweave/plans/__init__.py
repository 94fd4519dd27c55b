"""Registered queries (``catalog``) and their independent SQL oracles (``oracle``)."""
