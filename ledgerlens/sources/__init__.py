"""Schemas, the adapter from the driver tables, loaders and sinks."""
