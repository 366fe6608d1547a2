"""Scans of raw files and text columns, and the file plans behind them."""
