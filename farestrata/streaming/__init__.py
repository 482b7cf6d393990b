"""The pipeline driven by arriving files."""
