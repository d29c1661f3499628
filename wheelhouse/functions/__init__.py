"""Column functions: no state, no session, no Python workers."""
