from . import physical, sinks  # noqa: F401
