"""Errors a caller may want to catch."""


class HistoryError(Exception):
    """Base class."""


class SchemaMismatch(HistoryError):
    """The snapshot's columns are not the history's source columns."""


class DuplicateKeys(HistoryError):
    """A key that must be unique occurs more than once."""


class CorruptHistory(HistoryError):
    """The stored history breaks a rule every history must keep."""


class ConcurrentPublish(HistoryError):
    """Another load of the table is under way, or broke off and left its lock."""
