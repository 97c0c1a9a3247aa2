"""ionframe.functions."""
