"""functions of the transcript engine."""
