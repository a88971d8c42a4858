"""Readers and sinks of the field-sensing file layouts."""
