"""quality."""
