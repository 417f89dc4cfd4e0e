"""Plans: the warehouse layers and the named analytical queries over them."""
