"""Reading landed files and reports, and writing tables."""
