"""DataFrame transforms: layers, rules, windows, measures."""
