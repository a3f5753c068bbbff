"""Tables the engine reads and writes."""
