"""Statistical and causal operators."""
