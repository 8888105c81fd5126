"""Plans: the query catalogue and the reference's jobs wired from operators."""
