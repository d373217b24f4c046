"""Query definitions: the operators applied to concrete tables."""
