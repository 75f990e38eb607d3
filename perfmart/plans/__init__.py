"""Plans: the report as one lazy DataFrame plan, and the query catalogue."""
