"""cardlake.streaming."""
