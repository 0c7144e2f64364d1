from . import ingest  # noqa: F401
