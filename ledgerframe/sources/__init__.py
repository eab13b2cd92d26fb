"""Table contracts, readers and writers, fixed dimensions, and the order-table mapping."""
