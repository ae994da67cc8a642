"""Raw exports, layers of written tables."""
