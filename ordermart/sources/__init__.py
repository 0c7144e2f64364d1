from . import adapter, readers, schemas  # noqa: F401
from .adapter import SourceTables  # noqa: F401
