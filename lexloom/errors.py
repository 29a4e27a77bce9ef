"""Errors of the library."""


class LexloomError(Exception):
    """Base of all errors raised on purpose."""


class ConfigurationError(LexloomError):
    """A setting is out of its range."""


class MissingFileError(LexloomError):
    """A path that has to exist does not."""


class ValidationError(LexloomError):
    """A path is of the wrong kind, or a file is empty."""


class PdfProcessingError(LexloomError):
    """A PDF file cannot be read."""


class ParquetProcessingError(LexloomError):
    """A Parquet file cannot be read."""


class TextCleaningError(LexloomError):
    """A text cannot be read or cleaned."""
