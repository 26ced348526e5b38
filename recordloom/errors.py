"""Driver-side exceptions. Row-level problems are data (``reasons``), not exceptions."""


class RecordsError(Exception):
    """Base of every exception raised by this package."""


class ConfigurationError(RecordsError, ValueError):
    """A parameter, path or format definition is not usable."""


class GenerationError(RecordsError, RuntimeError):
    """A generation run cannot go on."""


class ValidationError(RecordsError, ValueError):
    """Data does not have the structure it must have."""


class LoaderError(RecordsError, RuntimeError):
    """Documents cannot be read, or none are left after reading."""


class OutputParserError(RecordsError, ValueError):
    """A model response is not the JSON it must be."""
