"""Relations of the model: bronze, silver, snapshots, star schema and marts."""
