"""plans of the transcript engine."""
