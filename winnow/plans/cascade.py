"""The ordered stage cascade."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, functions as F

from winnow.operators.combine import split_failed
from winnow.operators.flags import no
from winnow.sources.stages import commit_stage, manifest, read_stage, write_stage


@dataclass(frozen=True)
class Stage:
    """One stage.  ``test`` is a row condition; ``apply`` is any DataFrame function that returns the
    survivors (for stages with joins or Python calculators).  A stage with ``filters=False`` only adds
    columns.  ``ends_run`` stops the run when nobody survives.  ``version`` is for what ``made_by`` can't see of an
    ``apply``: the tables and settings that it reads."""

    name: str
    test: Column | None = None
    apply: Callable[[DataFrame], DataFrame] | None = None
    filters: bool = True
    enabled: bool = True
    ends_run: bool = False
    version: str = ""

    def made_by(self) -> str:
        """What decides about the stage's result, besides its input."""
        code = getattr(self.apply, "__code__", None)
        names = [getattr(self.apply, k, "") for k in ("__module__", "__qualname__")] if self.apply else []
        body = [code.co_code.hex(), *map(repr, (c for c in code.co_consts if not hasattr(c, "co_code"))), *code.co_names] if code else []
        return "|".join([self.name, str(self.test), str(self.filters), self.version, *names, *body])


class Cascade:
    def __init__(self, stages: Sequence[Stage]):
        self.stages = [s for s in stages if s.enabled]

    @property
    def filter_names(self) -> list[str]:
        return [s.name for s in self.stages if s.filters]

    def annotate(self, df: DataFrame) -> DataFrame:
        """Row conditions only: add ``pass_<stage>`` and the first ``failed_stage`` in one projection.

        Later flags are NULL once a row has failed, as later stages never see it.
        """
        alive, failed = F.lit(True), None
        flags: dict[str, Column] = {}
        for s in self.stages:
            if s.test is None or not s.filters:
                continue
            ok = no(s.test)
            flags[f"pass_{s.name}"] = F.when(alive, ok)
            missed = alive & ~ok
            failed = F.when(missed, s.name) if failed is None else failed.when(missed, s.name)
            alive = alive & ok
        return df.withColumns({**flags, "failed_stage": F.lit(None).cast("string") if failed is None else failed})

    def survivors(self, df: DataFrame) -> DataFrame:
        """One lazy plan through all stages."""
        for s in self.stages:
            df = self._step(s, df)
        return df

    @staticmethod
    def _step(stage: Stage, df: DataFrame) -> DataFrame:
        if stage.apply is not None:
            return stage.apply(df)
        return df.filter(stage.test) if stage.filters and stage.test is not None else df

    def digests(self, df: DataFrame, keys: Sequence[str], input_version: str = "") -> list[str]:
        """One per step, the input first; each covers all steps before it."""
        steps = [f"{df.schema.json()}|{input_version}|{list(keys)}", *(s.made_by() for s in self.stages)]
        out: list[str] = []
        for step in steps:
            out.append(hashlib.sha256(f"{out[-1] if out else ''}|{step}".encode()).hexdigest())
        return out

    def run_to_table(
        self, df: DataFrame, path: str, run_id: str, keys: Sequence[str], resume: bool = False, input_version: str = ""
    ) -> DataFrame:
        """Write survivors and failures of every stage to one table and go on from what was written.

        Each stage starts from files, so a lost executor costs at most one stage, and stages after an
        expensive one never recompute it. A stage is visible to readers once its manifest row is
        written, after its rows. With ``resume`` an interrupted run of the same id goes on after its
        last committed stage, as far as stages, keys and input schema are the same; ``input_version``
        tells inputs of one schema apart.
        """
        spark = df.sparkSession
        digests = self.digests(df, keys, input_version)
        done: dict[str, Row] = {}
        if resume:
            done = {r["stage"]: r for r in manifest(spark, path).filter(F.col("run_id") == run_id).collect()}

        def committed(name: str, rank: int) -> bool:
            return name in done and (done[name]["stage_rank"], done[name]["digest"]) == (rank, digests[rank])

        if not committed("input", 0):
            done = {}
            write_stage(df, path, run_id, "input", 0, "survivor")
            commit_stage(spark, path, run_id, "input", 0, digests[0])
        current = read_stage(spark, path, run_id, "input").select(*df.columns)
        for rank, s in enumerate(self.stages, start=1):
            after = self._step(s, current)
            if not committed(s.name, rank):
                done = {}  # what comes after is made anew, too
                write_stage(after, path, run_id, s.name, rank, "survivor")
                kept = read_stage(spark, path, run_id, s.name).select(*after.columns)
                if s.filters:
                    write_stage(split_failed(current, kept, keys), path, run_id, s.name, rank, "failed")
                commit_stage(spark, path, run_id, s.name, rank, digests[rank])
            current = read_stage(spark, path, run_id, s.name).select(*after.columns)
            if s.ends_run and current.isEmpty():
                break
        return current


def snapshot(df: DataFrame, describe: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Statistics of the survivors; the survivors themselves are not changed."""
    return describe(df)
