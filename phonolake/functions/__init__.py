"""Column-level building blocks: token layout and text expressions."""
