"""Plans: the weekly run, and the queries over the driver's tables with their SQL twins."""
