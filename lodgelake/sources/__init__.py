"""Sources and sinks: raw schemas, readers, the scrape view over the supplied tables, writers."""
