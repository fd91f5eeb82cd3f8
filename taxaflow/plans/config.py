"""Parameters of the pipeline's parts: defaults, files of ``label,value`` rows, and their checks."""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass, field, fields


@dataclass
class Params:
    """One set for all parts; labels of parameter files are the field names."""

    fastq: str = ""
    map: str = ""
    out: str = ""
    mismatches: int = 0
    length: int = 0
    max_ee: float = 1.0
    max_n: int | None = None
    algorithm: str = "UPARSE"
    identity: float = 0.97
    alpha: float = 2.0
    min_size: int | None = None
    strategy: int = 1
    group_columns: list[str] = field(default_factory=list)
    known: str = ""
    known_identity: float = 0.97
    email: str = ""
    threads: int = 1
    keep: str = ""
    exclude: str = ""
    mode: str = "reference"

    def check(self) -> None:
        problems = []
        if not 0 <= self.mismatches <= 5:
            problems.append("mismatches must be from 0 to 5")
        if self.algorithm not in ("UPARSE", "UNOISE3"):
            problems.append("algorithm must be UPARSE or UNOISE3")
        if not 0 < self.identity <= 1 or not 0 < self.known_identity <= 1:
            problems.append("identities must be in (0, 1]")
        if self.strategy not in (1, 2, 3):
            problems.append("strategy must be 1, 2 or 3")
        if self.strategy == 2 and not self.group_columns:
            problems.append("strategy 2 needs group columns")
        if self.strategy == 3 and not self.known:
            problems.append("strategy 3 needs known units")
        if self.email and not re.fullmatch(r"[^@\s]+@[^@\s]+\.[^@\s]+", self.email):
            problems.append("email isn't an address")
        if problems:
            raise ValueError("; ".join(problems))

    @property
    def smallest(self) -> int:
        """The least size of uniques: 8 for denoising and 1 for clustering unless set."""
        return self.min_size if self.min_size is not None else 8 if self.algorithm == "UNOISE3" else 1


def parse_rows(rows) -> Params:
    """Parameters from (label, value) rows; blank values and DEFAULT keep the default, unknown labels are refused."""
    out, kinds = Params(), {f.name: f.type for f in fields(Params)}
    for row in rows:
        if not row or not row[0].strip() or row[0].startswith("#"):
            continue
        label, value = row[0].strip().lower().replace(" ", "_"), row[1].strip() if len(row) > 1 else ""
        if label not in kinds:
            raise ValueError(f"unknown parameter {row[0]!r}")
        if value in ("", "DEFAULT"):
            continue
        kind = kinds[label]
        setattr(out, label, value.split("+") if kind.startswith("list") else int(value) if kind.startswith("int") else float(value) if kind == "float" else value)
    out.check()
    return out


def read_params(path: str) -> Params:
    with open(path, newline="") as f:
        return parse_rows(csv.reader(f))


def length_range(text: str, longest: int, step: int = 25) -> list[int]:
    """Lengths of the error statistics from ``a-b``; without it from 1 to 5 below the longest."""
    a, b = (int(x) for x in text.split("-")) if text else (1, longest - 5)
    if not 0 < a <= b <= longest or step < 1:
        raise ValueError("the range must lie within the reads' length")
    return list(range(a, b + 1, step))


def table_operation(multiply: float | None = None, divide: float | None = None, by_list: bool = False, normalize: bool = False) -> str:
    """The one operation of table arithmetic that is asked for."""
    asked = [n for n, x in (("multiply", multiply is not None), ("divide", divide is not None), ("list", by_list), ("normalize", normalize)) if x]
    if len(asked) != 1:
        raise ValueError("exactly one operation is needed")
    return asked[0]


def check_groups(values: list, a: str, b: str) -> None:
    """Two-group comparisons need both levels in the column, and two different ones."""
    missing = [x for x in (a, b) if x not in values]
    if missing or a == b:
        raise ValueError(f"levels {missing or [a]} can't be compared")
