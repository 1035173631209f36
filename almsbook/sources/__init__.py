"""Reading extracts and writing results."""
