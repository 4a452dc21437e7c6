"""Whole jobs built from the operators: table syncs, models, and the registered queries."""
