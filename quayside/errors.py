"""Errors a caller can act on."""


class QuaysideError(Exception):
    """Base of every error raised by this package."""


class SchemaConflict(QuaysideError):
    """Two schemas hold a field that cannot be merged."""

    def __init__(self, field: str, detail: str):
        self.field = field
        super().__init__(f"field '{field}': {detail}")


class LandingMissing(QuaysideError):
    """A load was asked for, but nothing was landed at the path."""


class UnsupportedLayout(QuaysideError):
    """The file layout of a landing dataset is not Parquet."""


class SplitNotPossible(QuaysideError):
    """A table cannot be read in ranges of a column of this type."""


class JobNotFound(QuaysideError):
    """No job of that name is registered."""
