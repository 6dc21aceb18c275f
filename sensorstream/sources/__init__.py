"""Sources: bus envelopes, keyed tables, declared streams, fixtures."""
