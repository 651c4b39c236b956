"""Errors with a code, an exit status for the command line, and a hint."""

from __future__ import annotations


class EngineError(Exception):
    code, exit_code = "TF000", 5

    def __init__(self, message: str, hint: str | None = None) -> None:
        super().__init__(message)
        self.hint = hint

    def shown(self) -> str:
        return f"tallyforge: {self.code}: {self}" + (f"\nhint: {self.hint}" if self.hint else "")


class InputError(EngineError, ValueError):
    """The user's files or options are wrong."""

    code, exit_code = "TF002", 2


class ConfigError(InputError):
    code = "TF201"


class SchemaError(InputError):
    code = "TF202"


class MissingArtifact(InputError):
    code = "TF203"


class ExternalError(EngineError):
    """Something outside the engine failed."""

    code, exit_code = "TF003", 3


class RemoteError(EngineError):
    code, exit_code = "TF004", 4


class ResourceError(RemoteError):
    code = "TF401"


class EvaluationError(EngineError, ValueError):
    code, exit_code = "TF005", 4


class InvariantError(EngineError, ValueError):
    """Data contradict what the engine guarantees."""

    code, exit_code = "TF005", 5


class SecurityError(EngineError):
    code, exit_code = "TF006", 5
