"""Build every dataset in dependency order, materialising each one.

The reference writes each dataset to disk and the next script reads it back.
Here each dataset is written as Parquet (partitioned by ``election_year``
where it has one) under ``out``, and downstream builders read the written
table.  That keeps every plan short, lets later steps prune partitions by
year, and makes each step restartable: a failed step reruns from its
written inputs, not from the raw feeds.

Order: D1 → D2, D3 → D4 → D5 → D6, D7, D8, D9 → D13; D10 and D12 after D4;
D11 on its own.  Inputs that are absent are skipped with their dependants.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..sources.sinks import write_parquet
from . import (candidate, chamber, coalition, declared, election, marginal_seat, membership, party, receipts,
               turnout, votes)

YEAR = "election_year"


def build_all(spark: SparkSession, raw: Mapping[str, object], out: str,
              timings: dict[str, float] | None = None) -> dict[str, str]:
    """``raw`` keys: ``municipality_dim``, ``coalition``, ``party``, ``votes_local``,
    ``votes_fed_state``, ``candidate``, ``details``, ``receipts`` (``{year: df}``),
    ``declared``, ``membership``.  Returns ``{dataset: path}``; ``timings``, when
    given, receives the seconds spent writing each dataset (lazy work included)."""
    out = out.rstrip("/")
    written: dict[str, str] = {}

    def save(name: str, df: DataFrame) -> DataFrame:
        path = f"{out}/{name}"
        t0 = time.perf_counter()
        write_parquet(df, path, [YEAR] if YEAR in df.columns else [])
        if timings is not None:
            timings[name] = round(time.perf_counter() - t0, 2)
        written[name] = path
        return spark.read.parquet(path)

    dim = raw["municipality_dim"]
    coal = save("coalition", coalition.build(raw["coalition"])) if "coalition" in raw else None
    if coal is None:
        return written
    if "party" in raw:
        save("party", party.build(raw["party"], coal, dim))
    levels = []
    for level in ("local", "fed_state"):
        key = f"votes_{level}"
        if key in raw:
            levels.append(save(f"election_{level}", votes.build(raw[key], coal, dim, level=level)))
    cand = save("candidate", candidate.build(raw["candidate"], coal, dim)) if "candidate" in raw else None
    if cand is not None and levels:
        elec = save("election", election.build(levels, cand))
        save("elected", election.elected_only(elec))
        save("election_chamber", chamber.build(elec))
        save("election_coalition", marginal_seat.build(elec))
        if "details" in raw:
            vc = save("vote_count", turnout.build(raw["details"], dim, elec))
            compare, per_mun = turnout.diagnostics(elec, vc)
            save("diagnostics_tally", compare)
            save("diagnostics_municipality", per_mun)
    if cand is not None and "receipts" in raw:
        for name, df in receipts.build(raw["receipts"], cand, dim).items():
            save(name, df)
    if cand is not None and "membership" in raw:
        save("filiado", membership.build(raw["membership"], cand, dim))
    if "declared" in raw:
        save("declaracao_receita", declared.build(raw["declared"], dim))
    return written
