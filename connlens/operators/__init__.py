"""connlens.operators."""
