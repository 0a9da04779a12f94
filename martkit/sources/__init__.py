"""Table sources and sinks."""
