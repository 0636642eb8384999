"""Running streaming tables over files."""
