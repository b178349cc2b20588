"""File listings, archives, delimited text and layered tables."""
