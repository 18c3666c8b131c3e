"""DataFrame operators: roll-ups, top lists, filters, collection, upsert, rules."""
