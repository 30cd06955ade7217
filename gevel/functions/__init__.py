"""Column functions: geometry, text, codes and exact quantiles."""
