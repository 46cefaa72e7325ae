"""Reading telemetry, writing results, and the bindings to the shared tables."""
