"""connlens.plans."""
