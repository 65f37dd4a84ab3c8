"""connlens.functions."""
