"""Error types that callers may rely on."""


class ScanError(ValueError):
    """The source cannot be scanned."""


class DatasetPreparationError(ValueError):
    """The dataset cannot be prepared as asked."""


class ConfigurationError(ValueError):
    """A setting is missing or has no valid value."""


class EmbeddingError(RuntimeError):
    """Texts could not be embedded."""


class KnowledgeStoreError(RuntimeError):
    """The vector collection cannot be read or written."""


class KnowledgeIndexError(RuntimeError):
    """Indexing or searching failed."""
