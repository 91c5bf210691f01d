"""Training-data operators (tokenising, deduplication, filtering, packing). Nothing else in the library imports this."""
