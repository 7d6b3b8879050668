"""Whole models: silver (M01-M04), gold (M05-M09) and ad hoc queries."""
