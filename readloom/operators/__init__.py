"""operators of the transcript engine."""
