"""Reading raw tables and writing finished ones."""
