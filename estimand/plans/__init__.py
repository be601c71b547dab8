"""Shared plan patterns: moments, finalizers, prefix sums, skew-safe ranks."""
