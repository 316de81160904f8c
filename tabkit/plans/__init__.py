"""Plan-level helpers (size-checked broadcast, skew salting, plan checks)
and the query bindings over the driver's tables."""
