"""Product schemas: a tree of rules that turns requested outputs into configuration and inputs, and inputs into outputs.

A node is a dictionary. ``filter:<key>`` holds branches by the value of a request's key (``*`` for any other; a branch
name may list values as ``a/b``); all other entries are settings that deeper nodes may override.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from nimbria.model import Step, coordinates
from nimbria.plans import windows as W
from nimbria.plans.requests import common_requests, deep_update, expand, squeeze, unique_requests

MARK = "filter:"


def _fits(branch: str, value) -> bool:
    return str(value) in branch.split("/")


def traverse(tree: dict, request: dict) -> dict:
    """Settings for one request: branches are followed in order, deeper settings win. No branch is an error."""
    out: dict = {}
    for key, value in tree.items():
        if not key.startswith(MARK):
            out = deep_update(out, {key: value})
    for key, branches in tree.items():
        if key.startswith(MARK):
            name = key[len(MARK) :]
            wanted = request.get(name)
            branch = next((b for k, b in branches.items() if k != "*" and _fits(k, wanted)), branches.get("*"))
            if branch is None:
                raise ValueError(f"no rule for {name}={wanted}")
            out = deep_update(out, traverse(branch, request))
    return out


def enumerate_outputs(tree: dict, wanted: dict, known: dict | None = None) -> list[tuple[dict, dict]]:
    """All (request keys, settings) of the tree whose settings include ``wanted``; ``*`` leaves a key open."""

    def walk(node: dict, keys: dict, settings: dict) -> list[tuple[dict, dict]]:
        own = deep_update(settings, {k: v for k, v in node.items() if not k.startswith(MARK)})
        filters = [(k[len(MARK) :], b) for k, b in node.items() if k.startswith(MARK)]
        if not filters:
            return [(keys, own)]
        states = [(keys, own)]
        for name, branches in filters:
            following = []
            for k, s in states:
                for branch, child in branches.items():
                    values = [None] if branch == "*" else branch.split("/")
                    for value in values:
                        if value is None and name in k or value is not None and name in k and str(k[name]) != value:
                            continue
                        following += walk(child, k if value is None else {**k, name: value}, s)
            states = following
        return states

    def includes(settings, part) -> bool:
        if isinstance(part, dict):
            return isinstance(settings, dict) and all(k in settings and includes(settings[k], v) for k, v in part.items())
        return settings == part

    return [(k, s) for k, s in walk(tree, dict(known or {}), {}) if includes(s, wanted)]


def input_steps(step: Step | str | int, available: list[int], deaccumulate: bool = False, include_start: bool = False) -> list[int]:
    """Input steps of an output step or range; deaccumulation needs the step before the first as its base."""
    s = Step.parse(step)
    inside = [a for a in sorted(available) if (s.start <= a if include_start or s.width == 0 else s.start < a) and a <= s.end]
    if not inside:
        raise ValueError(f"no input step for {s}")
    if deaccumulate:
        earlier = [a for a in sorted(available) if a < inside[0]]
        if not earlier:
            raise ValueError(f"nothing before step {inside[0]}")
        inside = [earlier[-1], *inside]
    return inside


def output_steps(available: list[int], kind: str, width: int = 0, interval: int = 0, date: dt.date | None = None) -> list[Step]:
    """Producible steps: instantaneous, ranges of a width at an interval, or calendar months."""
    steps = sorted(available)
    if not steps:
        return []
    if kind == "instantaneous":
        return [Step(s, s) for s in steps]
    if kind == "range":
        have = set(steps)
        return [Step(a, a + width) for a in range(steps[0], steps[-1] - width + 1, interval or width) if a in have and a + width in have]
    if kind == "monthly":
        return W.month_ranges(date, steps[0], steps[-1])
    raise ValueError(f"unknown step kind {kind!r}")


def climatology_step(step: Step | str | int, windows: list[Step], base_time: int = 0) -> Step:
    """The climatological window of the same width nearest by time of day (ties: the earlier)."""
    s = Step.parse(step)
    same = [w for w in windows if w.width == s.width]
    if not same:
        raise ValueError(f"no climatology window as wide as {s}")
    hour = (s.start + base_time) % 24
    away = lambda w: min((w.start - hour) % 24, (hour - w.start) % 24)
    return min(same, key=lambda w: (away(w), w.start))


def climatology_date(calendar_days: list[dt.date], date: dt.date) -> dt.date:
    """The last calendar day not after a date."""
    before = [d for d in calendar_days if d <= date]
    if not before:
        raise ValueError(f"no climatology date up to {date}")
    return max(before)


@dataclass
class Job:
    """A configuration: windows of each parameter, the requests they read, and the settings they came from."""

    param: str
    windows: list[dict]
    inputs: list[dict]
    settings: dict

    def mergeable(self, other: Job) -> bool:
        bare = lambda j: {k: v for k, v in j.settings.items() if k != "accumulations"}
        return self.param == other.param and bare(self) == bare(other)

    def merged(self, other: Job) -> Job:
        """Two jobs equal but for their windows over steps as one."""
        if not self.mergeable(other):
            raise ValueError("only jobs that differ in windows alone merge")
        windows = self.windows + [w for w in other.windows if w not in self.windows]
        return Job(self.param, windows, unique_requests(self.inputs + other.inputs), self.settings)


    def config(self, location: str, **more) -> dict:
        """What ``jobs.run`` takes: the settings' product, operation, keys and options, this job's windows under the steps' names,
        and its input requests at a location."""
        op = self.settings.get("operation", "aggregation")
        made = {"product": self.settings["product"], "keys": self.settings.get("keys", []), **self.settings.get("options", {})}
        made["source"] = {"location": location, "requests": self.inputs}
        made["windows"] = [{"type": "named", "name": w["step"], "coords": w["coords"], "operation": op} for w in self.windows]
        return {**made, **more}


class Schema:
    """Rules ``config`` and ``inputs`` (each a tree)."""

    def __init__(self, rules: dict):
        self.config, self.inputs = rules.get("config", {}), rules.get("inputs", {})

    def inputs_for(self, output: dict) -> list[dict]:
        """Input requests of an output request: rules name sources with key overrides and step settings."""
        rules = traverse(self.inputs, output)
        out = []
        for source in rules.get("sources", [{}]):
            base = {k: v for k, v in output.items() if k != "step"} | {k: v for k, v in source.items() if k != "steps"}
            spec = source.get("steps", rules.get("steps", {}))
            if "step" in output:
                available = coordinates(spec["available"]) if "available" in spec else list(range(Step.parse(output["step"]).start, Step.parse(output["step"]).end + 1, spec.get("by", 1)))
                base["step"] = input_steps(output["step"], available, spec.get("deaccumulate", False), spec.get("include_start", False))
            out.append(base)
        return out

    def job(self, output: dict) -> Job:
        settings = traverse(self.config, output)
        inputs = self.inputs_for(output)
        return Job(str(output.get("param")), [{"step": str(Step.parse(output["step"])), "coords": inputs[0].get("step", [])}] if "step" in output else [], inputs, settings)

    def from_outputs(self, outputs: list[dict]) -> list[Job]:
        """Jobs for requested outputs, merged where they differ in windows alone."""
        jobs: list[Job] = []
        for request in outputs:
            for one in squeeze(expand(request), [d for d in ("levelist", "number", "quantile") if d in request]):
                made = self.job(one)
                for i, j in enumerate(jobs):
                    if j.mergeable(made):
                        jobs[i] = j.merged(made)
                        break
                else:
                    jobs.append(made)
        return jobs

    def from_inputs(self, available: list[dict], outputs: list[dict]) -> list[dict]:
        """Those of the candidate outputs all of whose inputs are available."""
        have = [one for r in available for one in expand(r)]
        return [o for o in outputs for one in [o] if all(common_requests(expand(i), have) for i in self.inputs_for(one))]


def total_fields(sources: list[dict]) -> int:
    """Number of members that a parameter's requests return together."""
    counts = {len(expand({k: s[k] for k in ("number",) if k in s})) for s in sources}
    return sum(len(expand({k: s[k] for k in ("number",) if k in s})) for s in sources) if counts else 0


def quantile_list(text: str | list[str]) -> list[float]:
    """Levels of labels such as ``3:100``."""
    return [int(a) / int(b) for a, b in (t.split(":") for t in ([text] if isinstance(text, str) else text))]
