"""DataFrame operators: transforms, checks, conditions, actions, models."""
