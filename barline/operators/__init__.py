"""DataFrame operators (all lazy, all keyed by asset)."""
