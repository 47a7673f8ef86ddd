"""Column functions: text analysis, JSON and geography."""
