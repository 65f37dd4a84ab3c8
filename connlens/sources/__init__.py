"""connlens.sources."""
