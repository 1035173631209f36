"""Domain-free operators from DataFrame to DataFrame."""
