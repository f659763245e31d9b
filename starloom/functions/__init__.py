"""Column builders. Each takes and returns ``Column`` and stays inside code generation."""
