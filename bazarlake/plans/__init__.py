"""The layers: bronze, silver, gold, then business queries, quality and dictionary."""
