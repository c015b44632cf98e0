"""lexspark."""
