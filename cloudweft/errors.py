"""Errors that callers may catch."""


class ScanPackageError(ValueError):
    """A scan package is missing or malformed."""


class ConfigError(RuntimeError):
    """A required setting is absent or empty."""


class InsecureDirectoryError(RuntimeError):
    """A folder for downloads is not private to this user."""
