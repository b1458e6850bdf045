"""Table reads, sinks and model-state persistence."""
