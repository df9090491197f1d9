"""sources of the transcript engine."""
