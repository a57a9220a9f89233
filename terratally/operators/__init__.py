"""DataFrame-to-DataFrame operators: dimensions, emission rules, facts, checks."""
