"""Column functions: text, arrays, maps and the few Arrow UDFs."""
