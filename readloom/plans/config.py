"""Pipeline configuration from TOML, and the selection of steps."""

from __future__ import annotations

import random
import string
import time
import tomllib
from dataclasses import dataclass, field
from enum import IntEnum
from pathlib import Path


class Step(IntEnum):
    CCS = 1
    LIMA = 2
    REFINE = 3
    CLUSTER = 4
    MINIMAP2 = 5
    POLYA = 6
    FUSION = 7
    ORF = 8

    @classmethod
    def parse(cls, text) -> Step:
        """A step by number or by name."""
        try:
            return cls(int(text))
        except ValueError:
            pass
        try:
            return cls[str(text).strip().upper()]
        except KeyError:
            raise ValueError(f"unknown step {text!r}; steps are 1 to 8 or {', '.join(s.name.lower() for s in cls)}") from None

    @property
    def label(self) -> str:
        return self.name.lower()


def select_steps(first=None, last=None, only=(), skip=()) -> list[Step]:
    """Steps from ``first`` to ``last`` (all by default), or ``only`` those, without ``skip``; in order.

    ``only`` keeps repetitions and cannot be combined with a range.
    """
    if only and (first is not None or last is not None):
        raise ValueError("either a range of steps or single ones")
    if only:
        chosen = sorted(Step.parse(s) for s in only)
    else:
        a, b = Step.parse(first if first is not None else 1), Step.parse(last if last is not None else 8)
        if a > b:
            raise ValueError(f"step {a.label} comes after {b.label}")
        chosen = [s for s in Step if a <= s <= b]
    left_out = {Step.parse(s) for s in skip}
    return [s for s in chosen if s not in left_out]


@dataclass
class Config:
    metadata: dict[str, str] = field(default_factory=dict)
    packages: dict[str, str] = field(default_factory=dict)
    globals_: dict = field(default_factory=dict)
    params: dict[Step, dict] = field(default_factory=dict)
    steps: list[Step] = field(default_factory=lambda: list(Step))
    run_id: str = ""

    @classmethod
    def read(cls, path) -> Config:
        return cls.parse(Path(path).read_text())

    @classmethod
    def parse(cls, text: str) -> Config:
        raw = tomllib.loads(text)
        params = {Step.parse(name): dict(values) for name, values in raw.get("params", {}).items()}
        return cls(dict(raw.get("metadata", {})), dict(raw.get("packages", {})), dict(raw.get("global", {})), params)

    def select(self, **choice) -> Config:
        """Only these steps, and only their parameters."""
        self.steps = select_steps(**choice)
        self.params = {s: p for s, p in self.params.items() if s in self.steps}
        return self

    def get(self, step, key: str, kind: type | None = None, default=None):
        """A step's parameter; of another type than ``kind`` it is that type's zero."""
        value = self.params.get(Step.parse(step), {}).get(key, default)
        return value if kind is None or value is None or (type(value) is kind) else kind()

    def get_global(self, key: str, default=None):
        return self.globals_.get(key, default)

    def set(self, step, key: str, value) -> None:
        self.params.setdefault(Step.parse(step), {})[key] = value

    def remove(self, step, key: str | None = None) -> None:
        step = Step.parse(step)
        if key is None:
            self.params.pop(step, None)
        else:
            self.params.get(step, {}).pop(key, None)

    def flags(self, step, exclude=()) -> list[str]:
        """Parameters as command-line arguments: ``--key value``, ``-k value`` for keys of at most two letters, ``--secondary=value``."""
        out = []
        for key, value in self.params.get(Step.parse(step), {}).items():
            if key in exclude:
                continue
            text = str(value).lower() if isinstance(value, bool) else str(value)
            if key == "secondary":
                out.append(f"--{key}={text}")
            else:
                out += [f"--{key}" if len(key) > 2 else f"-{key}", text]
        return out

    def new_run_id(self, seed: int | None = None) -> str:
        """Four characters of base 36."""
        self.run_id = "".join(random.Random(seed if seed is not None else time.time_ns()).choices(string.digits + string.ascii_lowercase, k=4))
        return self.run_id

    def run_folder(self, base: str, now: float | None = None) -> str:
        return f"{base.rstrip('/')}/{self.run_id or self.new_run_id()}_{time.strftime('%Y%m%d%H%M', time.localtime(now))}"

    def step_folders(self, step, run_folder: str) -> tuple[str, str]:
        """(input, output) of a step: the input is the previous step's output."""
        step = Step.parse(step)
        out = f"{run_folder}/{step.value}_{step.label}"
        before = f"{run_folder}/{step.value - 1}_{Step(step.value - 1).label}" if step > 1 else str(self.get_global("input_dir", run_folder))
        return before, out
