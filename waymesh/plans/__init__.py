"""Plan-level helpers: durable intermediate results and prefix sums."""
