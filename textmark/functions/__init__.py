"""Column functions: row-wise, inside Catalyst, no shuffle."""
