"""Column functions: expressions only, no joins or actions."""
