"""Readers, parsers and writers for delimited and tagged text."""
