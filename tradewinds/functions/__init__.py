"""Column expressions with the null and ANSI rules of the library."""
