"""Bank tables derived from the generic test tables, and the checked queries."""
