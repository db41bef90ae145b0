"""Column expressions. Nothing here runs a job or calls Python per row."""
