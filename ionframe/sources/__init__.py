"""ionframe.sources."""
