"""Writers for stored tables and the load-state log."""
