"""Column functions: geometry, grid projection, costs, text output."""
