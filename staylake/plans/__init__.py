"""Models: staging, warehouse, marts and the analyst questions."""
