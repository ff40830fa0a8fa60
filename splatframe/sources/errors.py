"""Errors of the readers: a stable code and a message."""


class SourceError(ValueError):
    def __init__(self, code: str, message: str) -> None:
        super().__init__(f"[{code}] {message}")
        self.code, self.message = code, message
