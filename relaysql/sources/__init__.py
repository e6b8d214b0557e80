"""Message sources and sinks: topics, their text-file twin, driver tables."""
