"""Operators: indicators, signals, momentum, portfolio, upserts."""
