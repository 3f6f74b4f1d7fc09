"""Model builders: staging views, marts, warehouse load and incremental plans."""
