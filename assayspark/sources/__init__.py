"""File scans (S01-S14) and sinks."""
