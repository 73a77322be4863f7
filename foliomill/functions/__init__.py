"""Column functions: scalar text functions and predicates."""
