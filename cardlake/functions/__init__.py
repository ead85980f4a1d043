"""cardlake.functions."""
