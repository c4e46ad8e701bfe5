"""DataFrame to DataFrame operators without side effects."""
