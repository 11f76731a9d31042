"""Runnable jobs over tables on any store that Spark reaches: ``python -m jobs.<name> --help``."""
