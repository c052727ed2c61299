"""DataFrame operators: trips, traces, motion and rollups."""
