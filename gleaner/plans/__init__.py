from gleaner.plans import archive, catalogue, content, media  # noqa: F401
