"""Jobs over the layers, and the feeds and raw views that supply input."""
