"""Readers for landed files and writers for table layouts."""
