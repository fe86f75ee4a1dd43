"""Stage graph, and the catalogue of queries over the star-schema proxy tables."""
