"""Errors raised by the library."""


class ArgumentError(ValueError):
    """A query argument is outside its allowed range."""


class NotFoundError(LookupError):
    """The requested indicator does not exist."""


class NotEnoughDataError(ValueError):
    """A comparison asks for a period that has no rows."""


class CoverageError(ValueError):
    """The data holds values the reference tables do not map."""


class ContractError(AssertionError):
    """A layer breaks a rule it has to keep."""
