"""streaming of the transcript engine."""
