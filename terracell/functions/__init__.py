"""Column functions: no I/O, no actions, usable in any select."""
