"""Whole jobs: inventory, work matrix, batch run, coincidence, and the registered queries."""
