"""Column functions: the line codec, timestamps and wildcard rules."""
