"""Column builders: geodesy, clock and calendar, text, polygon rings."""
