"""Column functions: names, capacities, formats, lifecycle rules, page checks."""
