"""cardlake.operators."""
