"""Master-data tables to keyed, denormalised entities, as PySpark DataFrame jobs."""
