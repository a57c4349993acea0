"""Log lines, as text or JSON, that name the run they belong to."""

from __future__ import annotations

import json
import logging
import os
import sys
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

#: What a line says where no run is under way.
NO_RUN = "-"
#: Details of a record that JSON lines carry where given.
DETAILS = ("event", "metric", "value", "error_code")
_current: ContextVar[str] = ContextVar("ledgerly_run", default=NO_RUN)


@contextmanager
def within(run_id: str) -> Iterator[None]:
    """Lines logged inside belong to the run."""
    token = _current.set(run_id)
    try:
        yield
    finally:
        _current.reset(token)


class _Lines(logging.Formatter):
    def __init__(self, form: str):
        super().__init__("%(asctime)s %(levelname)s [%(run_id)s] %(name)s: %(message)s", "%Y-%m-%dT%H:%M:%S%z")
        self.form = form

    def format(self, record: logging.LogRecord) -> str:
        record.run_id = _current.get()
        if self.form == "text":
            return super().format(record)
        line = {"time": self.formatTime(record, self.datefmt), "level": record.levelname, "run_id": record.run_id, "logger": record.name, "message": record.getMessage()}
        line |= {k: getattr(record, k) for k in DETAILS if hasattr(record, k)}
        if record.exc_info:
            line["exception"] = self.formatException(record.exc_info)
        return json.dumps(line, ensure_ascii=False, default=str)


def configure(level: str = "INFO", form: str = "text", file: str | None = None) -> None:
    """Replaces what the engine's log writes to: standard output, and a file if one is named."""
    if form not in ("text", "json"):
        raise ValueError(f"unknown log format {form}")
    targets: list[logging.Handler] = [logging.StreamHandler(sys.stdout)]
    if file:
        os.makedirs(os.path.dirname(os.path.abspath(file)), exist_ok=True)
        targets.append(logging.FileHandler(file, encoding="utf-8"))
    own = logging.getLogger("ledgerly")
    for old in list(own.handlers):
        own.removeHandler(old)
        old.close()
    own.setLevel(level.upper())
    own.propagate = False
    for target in targets:
        target.setFormatter(_Lines(form))
        own.addHandler(target)
