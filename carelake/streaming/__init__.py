"""File-stream variants of the bronze load and of the vital-sign scoring."""
