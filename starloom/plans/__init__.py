"""The tables of the star schema, each a function from tables to a table."""
