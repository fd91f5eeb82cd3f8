"""Every query of the engine with the SQL it must agree with."""

from __future__ import annotations

from taxaflow.plans import lists, searches, sequencing, tables

QUERIES: dict = {**tables.Q, **searches.Q, **sequencing.Q, **lists.Q}
ORACLES: dict[str, str] = {**tables.O, **searches.O, **sequencing.O, **lists.O}
