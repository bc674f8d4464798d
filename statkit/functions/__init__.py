"""Column functions: text, codes and periods."""
