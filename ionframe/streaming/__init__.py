"""ionframe.streaming."""
