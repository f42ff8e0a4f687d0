"""DataFrame operators: joins, normalising, keys, entities, upsert."""
