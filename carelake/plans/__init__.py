"""Named datasets and queries, each a function of a Warehouse."""
