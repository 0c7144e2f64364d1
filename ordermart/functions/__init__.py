from . import columns, stats  # noqa: F401
