"""The registered queries, their SQL counterparts, and the data they prepare for themselves."""
