"""Frame operators: shape, dedupe, grain, lookups, ranking, quality, dimensions, facts."""
