"""Reading raw exports and reading / writing the table layers."""
