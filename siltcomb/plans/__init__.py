"""An extraction from its description to its tables."""
