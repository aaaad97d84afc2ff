"""DataFrame → DataFrame operators; keys, rules and mappings are parameters."""
