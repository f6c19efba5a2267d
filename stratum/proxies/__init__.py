"""Stand-ins that map the TPC-H-ish test tables onto the silver schemas, and the registered
queries (one per operator of the inventory) with their SQL oracles."""
