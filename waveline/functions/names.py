"""What names say: channels, chunk files, checkpoints, events, arms."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sensor bands by preference, and the channel letters of each role by preference.
BANDS = ("HH", "BH", "EH", "SH", "HN", "BN", "EN")
ROLES = {"Z": ("Z",), "N": ("N", "1"), "E": ("E", "2")}
CHUNK_NAME = r"^([A-Z0-9]+)_(\d{4}-\d{2}-\d{2})\.zip$"
RUN_TAIL = r"_pid\d+_seed\d+\.pth$"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def band_of(channel: Column | str) -> Column:
    """All of a channel code but its last letter, in upper case."""
    c = F.upper(_col(channel))
    return F.substring(c, F.lit(1), F.length(c) - 1)


def role_letter(channel: Column | str) -> Column:
    """The last letter of a channel code, in upper case; a bare role is its own."""
    return F.upper(F.right(_col(channel), F.lit(1)))


def role_of(channel: Column | str) -> Column:
    """Z, N or E by the channel's letter; null for another letter."""
    letter, out = role_letter(channel), F.lit(None).cast("string")
    for role, letters in ROLES.items():
        out = F.when(letter.isin(*letters), role).otherwise(out)
    return out


def chunk_station(name: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_col(name), CHUNK_NAME, 1), F.lit(""))


def chunk_date(name: Column | str) -> Column:
    """The day in a chunk's file name or stem, else null."""
    return F.nullif(F.regexp_extract(_col(name), r"_(\d{4}-\d{2}-\d{2})(?:\.zip)?$", 1), F.lit(""))


def reject_reason(name: Column | str) -> Column:
    """Why a file is no chunk; null for a conforming name. The first reason that fits counts."""
    c = _col(name)
    reason = F.when(c.endswith(".part") | c.startswith("incoming."), "download in flight").when(F.contains(c, F.lit(".dup")), "duplicate delivery")
    return F.when(~c.rlike(CHUNK_NAME), reason.otherwise("unrecognised name"))


def run_identity(name: Column | str) -> Column:
    """A checkpoint's name without process and seed."""
    return F.regexp_replace(_col(name), RUN_TAIL, "")


def event_tag(event_id: Column | str) -> Column:
    """The file stem of an event's window; it must hold nothing but the id."""
    return F.concat(F.lit("event_"), _col(event_id).cast("bigint").cast("string"))


def magnitude_band(magnitude: Column | str) -> Column:
    """Half-magnitude bands, all above 6 in one; cut toward zero."""
    return (F.least(_col(magnitude), F.lit(6.0)) * 2).cast("int") / F.lit(2.0)


@dataclass(frozen=True)
class Arm:
    """A detector's window geometry and where its weights are."""

    name: str
    window_seconds: float
    checkpoints: str
    branch: str
    step_seconds: float
    fs: float = 100.0

    @classmethod
    def parse(cls, spec: str, fs: float = 100.0) -> Arm:
        """``NAME:WINDOW:CHECKPOINTS:BRANCH[:STEP]``; the step is the window unless given."""
        parts = spec.split(":")
        if len(parts) not in (4, 5):
            raise ValueError(f"an arm is NAME:WINDOW:CHECKPOINTS:BRANCH[:STEP], not {spec!r}")
        return cls(parts[0], float(parts[1]), parts[2], parts[3], float(parts[-1] if len(parts) == 5 else parts[1]), fs)

    @property
    def win(self) -> int:
        return int(round(self.window_seconds * self.fs))

    @property
    def step(self) -> int:
        return int(round(self.step_seconds * self.fs))


def arm_columns(spec: Column | str, fs: float = 100.0) -> dict[str, Column]:
    """The same as columns, for a table of specs; all null where the spec has not 4 or 5 fields."""
    parts = F.split(_col(spec), ":")
    ok = F.size(parts).isin(4, 5)
    window = F.get(parts, F.lit(1)).cast("double")
    step = F.coalesce(F.get(parts, F.lit(4)).cast("double"), window)
    named = {"name": F.get(parts, F.lit(0)), "window_seconds": window, "checkpoints": F.get(parts, F.lit(2)), "branch": F.get(parts, F.lit(3)), "step_seconds": step, "win": F.rint(window * fs).cast("int"), "step": F.rint(step * fs).cast("int")}
    return {k: F.when(ok, c) for k, c in named.items()}


def even_places(n: int, k: int) -> list[int]:
    """``k`` places spread evenly over ``n``, ends included, halves to the even place."""
    k = min(k, n)
    return [round(j * (n - 1) / (k - 1)) if k > 1 else 0 for j in range(k)] if n else []
