"""Plan shapes shared by the operators: rollups, shares, top-K, dimension joins."""
