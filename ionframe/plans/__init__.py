"""ionframe.plans."""
