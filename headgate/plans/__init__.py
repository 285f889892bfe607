"""Statistics, split plans and row-position plans."""
