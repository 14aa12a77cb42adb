"""Errors by stage."""


class HeronryError(Exception):
    pass


class ManifestError(HeronryError):
    """A manifest that cannot be read or holds unknown values."""


class IngestError(HeronryError):
    pass


class FetchError(IngestError):
    pass


class HashMismatch(IngestError):
    def __init__(self, source: str, expected: str, actual: str):
        super().__init__(f"source {source}: hash mismatch (expected {expected}, got {actual})")
        self.source, self.expected, self.actual = source, expected, actual


class EmbedError(HeronryError):
    pass


class DimensionMismatch(EmbedError):
    def __init__(self, expected: int, got: int):
        super().__init__(f"dimension mismatch: expected {expected}, got {got}")
        self.expected, self.got = expected, got


class StoreError(HeronryError):
    """Chunks and vectors that do not belong together."""


class SearchError(HeronryError):
    """A corpus folder that cannot be searched."""


class EvalError(HeronryError):
    """A strategy whose index cannot be loaded."""
