"""Whole runs: cleaning, staged features, panels, padded ranges."""
