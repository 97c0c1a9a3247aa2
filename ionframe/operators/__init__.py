"""ionframe.operators."""
