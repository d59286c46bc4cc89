"""Errors a caller can tell apart."""


class EngineError(Exception):
    """A refusal or failure; number and severity as a server would report them, where there is one."""

    def __init__(self, message: str, number: int = 0, severity: int = 16):
        super().__init__(message)
        self.number, self.severity = number, severity

    @property
    def fatal(self) -> bool:
        return self.severity >= 20


class ReadOnly(EngineError):
    def __init__(self, operation: str, catalog: str):
        super().__init__(f"{operation} is not possible: catalog {catalog} is attached read-only")


class NotFound(EngineError):
    pass


class Exists(EngineError):
    pass


class Refused(EngineError):
    """What the engine never does, such as a nested column in a table."""


class Conflict(EngineError):
    """Another writer has changed the table meanwhile."""
