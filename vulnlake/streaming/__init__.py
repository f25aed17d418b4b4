"""Events: contract, routing, and the replay and ingest streams."""
