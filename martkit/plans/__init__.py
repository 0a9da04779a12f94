"""Plans built from the operators: star schema, query catalogue, measures, report queries."""
