"""DataFrame operators: spatial lookup, revenue model, per-area aggregates, comparison."""
