"""Errors raised by the data-quality guards."""


class LoadError(RuntimeError):
    """A load cannot go on; no table has been changed."""


class ConfigError(LoadError):
    """Configuration is missing or incomplete."""


class MissingColumns(LoadError):
    """A frame lacks required columns."""


class UnknownColumns(LoadError):
    """Rows hold columns that the table lacks and that would be lost."""


class IncompatibleTypes(LoadError):
    """A column has changed to a type that does not hold the values it had."""


class UnmarkedRows(LoadError):
    """Source rows have no value in the watermark column."""


class MissingTable(LoadError):
    """A required table does not exist."""


class EmptySnapshot(LoadError):
    """A full extract holds no usable rows; going on would mark every key as deleted."""


class DuplicateKeys(LoadError):
    """A merge source holds more than one row for a key."""
