"""Plans: end-to-end pipeline, tuning loops, registered queries."""
