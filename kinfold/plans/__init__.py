"""Query plans over the derived feeds, and their SQL."""
