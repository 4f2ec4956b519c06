"""A single writer on the driver's machine, with recovery from owners that are gone."""

from __future__ import annotations

import json
import os
from pathlib import Path


def _started(pid: int) -> str | None:
    """The process's start time, which tells it from a later one with its number; None if it is gone."""
    try:
        return Path(f"/proc/{pid}/stat").read_text().rpartition(")")[2].split()[19]
    except OSError:
        return None


class WriterLock:
    def __init__(self, path: str):
        self.path = path

    def __enter__(self) -> WriterLock:
        for _ in range(2):
            try:
                fd = os.open(self.path, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
            except FileExistsError:
                owner = json.loads(Path(self.path).read_text() or "{}")
                if owner and _started(owner["pid"]) == owner["started"]:
                    raise RuntimeError(f"process {owner['pid']} holds {self.path}") from None
                os.unlink(self.path)
                continue
            with os.fdopen(fd, "w") as f:
                json.dump({"pid": os.getpid(), "started": _started(os.getpid())}, f)
            return self
        raise RuntimeError(f"could not lock {self.path}")

    def __exit__(self, *_) -> None:
        os.unlink(self.path)
