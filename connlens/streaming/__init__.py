"""connlens.streaming."""
