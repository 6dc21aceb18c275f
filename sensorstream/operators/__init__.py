"""DataFrame -> DataFrame operators (decode, filter, aggregate, windows, top-n)."""
