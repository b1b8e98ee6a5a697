"""Plan shapes shared by the operators: durable hand-over, prefix sums, keyed lookups."""
