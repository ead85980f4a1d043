"""cardlake.sources."""
