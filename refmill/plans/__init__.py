"""Jobs built from the operators: extraction, load, publish, audit, and the query catalogue."""
