"""Frame-to-frame operators: cleaning, joining, nesting, conforming, ranking."""
