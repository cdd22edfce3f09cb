"""Sources (S1-S7) and sinks."""
