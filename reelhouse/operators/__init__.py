"""Composite operators Spark has no single primitive for (expressed with built-ins)."""
