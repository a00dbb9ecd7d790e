from gleaner.functions import blobs, names, predicates, retry, text, urls  # noqa: F401
