"""Jobs composed from sources and operators."""
