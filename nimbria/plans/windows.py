"""Window generators. A window is a named set of coordinates with an operation; all windows of a job form one small
table, so a single scan of the fields feeds every window by one join."""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass, field, replace
from itertools import product

from pyspark.sql import DataFrame, SparkSession

from nimbria.model import Step, coordinates

OPERATIONS = ("sum", "minimum", "maximum", "mean", "weighted_mean", "integral", "difference", "difference_rate", "standard_deviation", "histogram", "aggregation")


@dataclass(frozen=True)
class Window:
    """Coordinates along one dimension and what to do with them.

    sequential: gaps are allowed; the window ends with its last coordinate. deaccumulate: the operation works on
    differences of consecutive values. weights: for weighted_mean; default interval widths over the span.
    """

    window_id: str
    coords: tuple[int, ...]
    op: str = "aggregation"
    dim: str = "step"
    sequential: bool = False
    deaccumulate: bool = False
    factor: float = 1.0
    weights: tuple[float, ...] | None = None
    bins: tuple[float, ...] | None = None
    mod: float | None = None
    normalise: bool = True
    scale_out: float = 1.0
    meta: dict = field(default_factory=dict, hash=False, compare=False)

    def __post_init__(self):
        if self.op not in OPERATIONS:
            raise ValueError(f"unknown operation {self.op!r}")
        if not self.coords:
            raise ValueError(f"window {self.window_id} has no coordinates")
        if self.op == "histogram" and (not self.bins or len(self.bins) < 2):
            raise ValueError("a histogram needs bin edges")
        if self.op == "difference" and len(self.coords) > 2 or self.op == "difference_rate" and len(self.coords) > 2:
            raise ValueError(f"{self.op} takes one or two coordinates")

    def coord_weights(self) -> dict[int, float]:
        if self.op != "weighted_mean":
            return {}
        if self.weights is not None:
            if len(self.weights) != len(self.coords):
                raise ValueError("one weight a coordinate is needed")
            return dict(zip(self.coords, self.weights, strict=True))
        span = self.coords[-1] - self.coords[0]
        return {b: (b - a) / span for a, b in zip(self.coords, self.coords[1:], strict=False)}


def name(coords) -> str:
    """``min-max`` of coordinates, or the only one."""
    first, last = min(coords), max(coords)
    return str(first) if first == last else f"{first}-{last}"


def default(specs: list, op: str = "aggregation", dim: str = "step", **options) -> list[Window]:
    """A window for each specification of coordinates."""
    made = [tuple(coordinates(s)) for s in specs]
    return [Window(name(c), c, op, dim, **options) for c in made]


def step_ranges(start: int, end: int, width: int, interval: int, by: int = 1, op: str = "aggregation", **options) -> list[Window]:
    """Tumbling (interval = width) or sliding (interval < width) windows; width 0 gives instants."""
    firsts = range(start, end - width + 1, interval)
    return [Window(name((a, a + width)), tuple(range(a, a + width + 1, by)) if width else (a,), op, **options) for a in firsts]


def month_ranges(date: dt.date, start: int, end: int) -> list[Step]:
    """Full calendar months, as steps in hours after ``date``; the start is rounded up to a month's first day and a
    partial last month is dropped."""
    zero = dt.datetime(date.year, date.month, date.day)
    first = zero + dt.timedelta(hours=start)
    month = dt.datetime(first.year, first.month, 1)
    if month < first:
        month = _next_month(month)
    out = []
    while (month_end := _next_month(month)) <= zero + dt.timedelta(hours=end):
        out.append(Step(int((month - zero).total_seconds() // 3600), int((month_end - zero).total_seconds() // 3600)))
        month = month_end
    return out


def _next_month(day: dt.datetime) -> dt.datetime:
    return day + dt.timedelta(days=calendar.monthrange(day.year, day.month)[1])


def monthly(date: dt.date, start: int, end: int, by: int, op: str = "mean", **options) -> list[Window]:
    """A window for each month: the steps after its beginning up to its end."""
    return [Window(str(m), tuple(range(m.start + by, m.end + 1, by)), op, **options) for m in month_ranges(date, start, end)]


def forecast_month(date: dt.date, step: Step) -> int:
    """Number (from 1) of the calendar month that a step range covers in full."""
    begin = dt.datetime(date.year, date.month, date.day) + dt.timedelta(hours=step.start)
    if begin.day != 1 or step.width != 24 * calendar.monthrange(begin.year, begin.month)[1]:
        raise ValueError(f"{step} is not a calendar month after {date}")
    return (begin.year - date.year) * 12 + begin.month - date.month + (1 if date.day == 1 else 0)


#: Operations that leave out a range's first coordinate, and how a header codes a window's time.
FOLDING = ("sum", "minimum", "maximum", "mean", "aggregation", "standard_deviation")
LONG_STEP, LONG_RANGE_UNIT, LONG_INSTANT, FIRST_INSTANT, INSTANT = 256, 11, 10, 1, 0


@dataclass(frozen=True)
class Span:
    """What an older configuration says of one window: its ends, its coordinates and whether the first of them counts."""

    first: int
    last: int
    coords: tuple
    whole: bool

    @classmethod
    def of(cls, coords, include_start: bool) -> Span:
        """``coords`` is {from, to, by}, a list of coordinates, or the text "a-b" in a list, one coordinate that is whole."""
        match coords:
            case dict():
                steps = coordinates({"from": 0, **coords})
            case [str() as text]:
                return cls(*map(int, text.split("-")), (text,), True)
            case _:
                steps = list(coords)
        return cls(steps[0], steps[-1], tuple(steps), include_start or steps[0] == steps[-1])

    def inputs(self, op: str) -> tuple:
        """A folding operation works on what follows the range's beginning, unless the range is whole."""
        return self.coords if self.whole or op not in FOLDING else self.coords[1:]

    def label(self, prefix: str, number: int, op: str | None) -> str:
        return "_".join([f"{prefix}{name((self.first, self.last))}", *([op] if op else []), str(number)])

    def header(self, given: dict) -> dict:
        """Time keys: an indicator for an instant, a type for a range, a longer unit for one far out in the first edition. What is
        given stays, but for the range, which is always the window's; an instant whose step is given keeps a range as well."""
        instant, far = self.first == self.last, self.last >= LONG_STEP
        keys = {}
        if instant:
            keys["timeRangeIndicator"] = LONG_INSTANT if far else INSTANT if self.last else FIRST_INSTANT
        elif far and given.get("edition", 1) == 1:
            keys["unitOfTimeRange"] = LONG_RANGE_UNIT
        if instant and "step" not in given:
            return {**keys, **given, "step": str(self.last)}
        return {"stepType": "max", **keys, **given, "stepRange": name((self.first, self.last))}


def _by_operation(spec: dict) -> dict[str, list[dict]]:
    """The thresholds of a specification under its operation, or under those that their senses ask for."""
    limits = [{**t, "value": float(t["value"])} for t in spec.get("thresholds", [])]
    if "operation" in spec:
        return {spec["operation"]: limits}
    ops = [infer_operation(t["comparison"]) for t in limits]
    return {op: [t for t, o in zip(limits, ops, strict=True) if o == op] for op in dict.fromkeys(ops)} or {"aggregation": []}


def legacy(config: dict, keys: dict | None = None) -> tuple[list[Window], list[dict]]:
    """Windows of older configurations and the thresholds of each: ``windows`` and, named with the prefix ``std_``,
    ``std_anomaly_windows``, lists of {coords, operation?, thresholds?, include_start?, factor?, deaccumulate?, metadata?}.

    ``coords`` is a list of windows as ``Span.of`` reads them. Windows are sequential. Without an operation the thresholds'
    sense decides; thresholds of unlike sense make a window for each. ``keys`` and metadata go to the header, which windows
    carry as ``meta``.
    """
    made: list[Window] = []
    thresholds: list[dict] = []
    for prefix, part in (("", "windows"), ("std_", "std_anomaly_windows")):
        for number, spec in enumerate(config.get(part, [])):
            found, given = _by_operation(spec), {**(keys or {}), **spec.get("metadata", {})}
            spans = [Span.of(c, bool(spec.get("include_start", False))) for c in spec["coords"]]
            for op, span in product(found, spans):
                window_id = span.label(prefix, number, op if len(found) > 1 else None)
                factor = float(spec.get("factor", 1.0)) if op == "difference_rate" else 1.0
                made.append(Window(window_id, span.inputs(op), op, sequential=True, deaccumulate=spec.get("deaccumulate", False), factor=factor, meta=span.header(given)))
                thresholds += [{"window_id": window_id, "comparison": t["comparison"], "threshold": t["value"]} for t in found[op]]
    return made, thresholds


def infer_operation(comparison: str | None, op: str | None = None) -> str:
    """The operation of a threshold window: given, else by the comparison's sense; without a comparison aggregation."""
    if op:
        return op
    sign = (comparison or "").strip()
    if sign and not set(sign) & {"<", ">"}:
        raise ValueError(f"unknown threshold comparison {comparison!r}")
    return "minimum" if "<" in sign else "maximum" if ">" in sign else "aggregation"


def threshold_windows(specs: list[dict]) -> tuple[list[Window], list[dict]]:
    """Windows and the thresholds of each, from specifications {coords, thresholds: [{comparison, value}], op?, std?}.

    Thresholds of unlike sense split a window in two operations; standardised windows get the prefix ``std_``. A
    window without a threshold is an error.
    """
    windows: dict[str, Window] = {}
    thresholds = []
    for spec in specs:
        if not spec.get("thresholds"):
            raise ValueError(f"no threshold for window {spec.get('coords')}")
        coords = tuple(coordinates(spec["coords"]))
        for t in spec["thresholds"]:
            op = infer_operation(t["comparison"], spec.get("op"))
            key = f"{'std_' if spec.get('std') else ''}{name(coords)}_{op}"
            windows[key] = Window(key, coords, op)
            thresholds.append({"window_id": key, "comparison": t["comparison"], "threshold": float(t["value"])})
    return list(windows.values()), thresholds


def date_sequence(calendar_days: list[dt.date], around: dt.date, before: int = 0, after: int = 0, strict: bool = False) -> list[dt.date]:
    """``before`` entries of a calendar up to a date and ``after`` from it on; ``strict`` leaves the date itself out."""
    days = sorted(set(calendar_days))
    past = [d for d in days if (d < around if strict else d <= around)]
    future = [d for d in days if d > around]
    return past[len(past) - before :] + future[:after] if before else future[:after]


def date_range(calendar_days: list[dt.date], first: dt.date, last: dt.date) -> list[dt.date]:
    return [d for d in sorted(set(calendar_days)) if first <= d <= last]


def model_steps() -> list[int]:
    """Hourly to 90, three-hourly to 144, six-hourly to 246."""
    return [*range(0, 91), *range(93, 145, 3), *range(150, 247, 6)]


def product_windows(dims: dict[str, list[Window]]) -> list[dict[str, Window]]:
    """All combinations of windows of several dimensions; the last dimension varies fastest and folds first."""
    return [dict(zip(dims, combo, strict=True)) for combo in product(*dims.values())]


def combined_name(combo: dict[str, Window]) -> str:
    return next(iter(combo.values())).window_id if len(combo) == 1 else ":".join(f"{k}_{w.window_id}" for k, w in combo.items())


def needed_coords(windows: list[Window]) -> list[int]:
    """Sorted union of coordinates: what a scan has to read."""
    return sorted({c for w in windows for c in w.coords})


def unique(windows: list[Window]) -> list[Window]:
    seen: dict[str, int] = {}
    for w in windows:
        seen[w.window_id] = seen.get(w.window_id, 0) + 1
    twice = [k for k, n in seen.items() if n > 1]
    if twice:
        raise ValueError(f"window names repeat: {twice}")
    return windows


def frame(spark: SparkSession, windows: list[Window]) -> DataFrame:
    """One row per window and coordinate."""
    rows = []
    for w in unique(windows):
        weights = w.coord_weights()
        for i, c in enumerate(w.coords):
            if w.op == "weighted_mean" and c not in weights or w.op == "integral" and i == 0:
                continue
            if isinstance(c, str):
                raise ValueError(f"window {w.window_id} has the coordinate {c!r}: its fields are keyed by text, not by number")
            rows.append((w.window_id, int(c), i, weights.get(c), len(w.coords), int(w.coords[0]), int(w.coords[-1]), w.sequential))
    return spark.createDataFrame(rows, "window_id string, coord int, ord int, weight double, n_coords int, first_coord int, last_coord int, sequential boolean")


def renamed(windows: list[Window], prefix: str) -> list[Window]:
    return [replace(w, window_id=f"{prefix}{w.window_id}") for w in windows]
