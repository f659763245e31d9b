"""Table operators: each takes and returns ``DataFrame``."""
