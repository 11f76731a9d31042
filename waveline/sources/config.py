"""Settings: the nearest TOML file upward, overridden by flags."""

from __future__ import annotations

import os
import tomllib
from dataclasses import dataclass, field

NAME = "waveline.toml"
PATHS = ("archive", "stations", "catalog", "out")


@dataclass
class Config:
    archive: str | None = None
    stations: str | None = None
    catalog: str | None = None
    out: str | None = None
    ledgers: list[str] = field(default_factory=list)

    def require(self, *names: str) -> None:
        """An error that says which settings are missing and how to give them."""
        missing = [n for n in names if not getattr(self, n)]
        if missing:
            raise ValueError(f"missing: {', '.join(missing)}; set them in {NAME} or by --{' --'.join(missing)}")


def find(start: str = ".") -> str | None:
    """The nearest settings file in ``start`` or above it."""
    at = os.path.abspath(start)
    while True:
        if os.path.exists(path := os.path.join(at, NAME)):
            return path
        if os.path.dirname(at) == at:
            return None
        at = os.path.dirname(at)


def load(flags: dict | None = None, start: str = ".") -> Config:
    """Paths in the file are relative to it, flags to the working folder; flags win."""
    flags, out, path = flags or {}, Config(), find(start)
    if path:
        with open(path, "rb") as f:
            found = tomllib.load(f)
        base = os.path.dirname(path)
        place = lambda p: p if "://" in p else os.path.normpath(os.path.join(base, p))
        for n in PATHS:
            if found.get(n):
                setattr(out, n, place(found[n]))
        out.ledgers = [place(p) for p in found.get("ledgers", [])]
    for n in PATHS:
        if flags.get(n):
            setattr(out, n, flags[n])
    if flags.get("ledger"):
        out.ledgers = list(flags["ledger"])
    return out
