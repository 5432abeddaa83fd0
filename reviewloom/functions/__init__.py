"""Column functions: text normalisation, display attributes, guarded arithmetic."""
