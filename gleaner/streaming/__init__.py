from gleaner.streaming import bounded, ingest, merge, state, timers  # noqa: F401
