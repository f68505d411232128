"""The data model: fields as a long table, steps, coordinate specifications.

A *field* is one row per (metadata keys..., ``point_id``) with ``value double``; the ensemble member is ``number``, the
time axis ``step``. Missing is NaN inside the engine, as arithmetic then propagates it; NULL means "no such cell".
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import total_ordering

#: Schemas, in DDL.
FIELDS = "param string, levtype string, levelist int, stream string, type string, date int, time int, number int, step int, hdate int, quantile int, point_id int, value double, meta map<string,string>"
GRID = "point_id int, lat double, lon double"
TRACKS = "number int, id int, step int, lat double, lon double, wind double, msl double"
CHECKPOINTS = "config string, window_id string, at bigint"


@total_ordering
@dataclass(frozen=True)
class Step:
    """An instant (start = end) or a range of hours; ordered by end, then start."""

    start: int
    end: int

    @classmethod
    def parse(cls, text: str | int | Step) -> Step:
        """``24`` or ``"24"`` is an instant, ``"0-24"`` a range."""
        if isinstance(text, Step):
            return text
        first, dash, last = str(text).partition("-")
        start = int(first)
        end = int(last) if dash else start
        if end < start:
            raise ValueError(f"step range {text} ends before it starts")
        return cls(start, end)

    def __lt__(self, other: Step) -> bool:
        return (self.end, self.start) < (other.end, other.start)

    def __str__(self) -> str:
        return str(self.start) if self.start == self.end else f"{self.start}-{self.end}"

    @property
    def width(self) -> int:
        return self.end - self.start

    def grown(self, hours: int) -> Step:
        return Step(self.start, self.end + hours)

    def plain(self) -> int | Step:
        """An instant as its number, a range as it is."""
        return self.start if self.start == self.end else self


def coordinates(spec) -> list:
    """Coordinates of a specification: ``{from, to, by}`` inclusive, one value, or a list of these; kept in order."""
    if isinstance(spec, dict):
        first, last, by = spec.get("from", 0), spec["to"], spec.get("by", 1)
        if by <= 0:
            raise ValueError("'by' must be positive")
        return list(range(first, last + 1, by))
    if isinstance(spec, list | tuple | range):
        return [c for item in spec for c in coordinates(item)]
    return [spec]
