"""End-to-end chains of the operators."""
