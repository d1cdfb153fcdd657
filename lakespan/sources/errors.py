"""Errors a user can meet; those found together are reported together."""


class BridgeError(Exception):
    """Any failure of reading or writing; errors lists the single causes."""

    def __init__(self, message: str, errors: list[str] | None = None):
        super().__init__(message + "".join(f"\n- {e}" for e in errors or []))
        self.errors = errors or [message]


class OptionError(BridgeError):
    pass


class SchemaError(BridgeError):
    pass


class TableStateError(BridgeError):
    pass


class ToleranceError(BridgeError):
    """More rows were rejected than may be; rejects names the table that keeps them."""

    def __init__(self, message: str, rejects: str | None = None):
        super().__init__(message)
        self.rejects = rejects


class MergeError(BridgeError):
    pass


class ExternalTableError(BridgeError):
    pass
