"""Column functions: everything here is an expression inside the plan."""
