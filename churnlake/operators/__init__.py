"""DataFrame -> DataFrame operators.  See README for the inventory."""
