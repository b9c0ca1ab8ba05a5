"""Feed and reference-file readers."""
