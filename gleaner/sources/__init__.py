from gleaner.sources import blobs, listings, manifests, sinks, tables  # noqa: F401
