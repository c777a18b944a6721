"""Starting, watching and stopping staged runs: job tags for their work, a state file for each change."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone
from threading import Event, Lock

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession

from helixframe.plans.manifest import Folder
from helixframe.plans.pipeline import Run
from helixframe.schemas import conform


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


@dataclass
class _Live:
    stop: Event
    thread: InheritableThread


class AlreadyRunning(RuntimeError):
    """There is a run over this folder."""


@dataclass
class Control:
    """Runs over one folder from this driver, one at a time. Their states outlive the driver; a run that was going on when it ended has failed."""

    spark: SparkSession
    folder: str
    live: dict[str, _Live] = field(default_factory=dict)
    _lock: Lock = field(default_factory=Lock)

    def __post_init__(self):
        self.states = Folder(self.spark, f"{self.folder}/_runs")

    def _read(self, run: str) -> dict:
        names = self.states.names(run)
        return json.loads(self.states.read(f"{run}/{names[-1]}")) if names else {}

    def _write(self, run: str, **changes) -> None:
        with self._lock:
            state = self._read(run) | changes
            self.states.write(f"{run}/{len(self.states.names(run)):08d}.json", json.dumps(state))

    def start(self, first: str | None = None, until: str | None = None, force: bool = False, species_ids: list[str] | None = None, notes: str | None = None) -> str:
        """POST /pipeline/run: the id of a run that now goes on by itself."""
        if any(x.thread.is_alive() for x in self.live.values()):
            raise AlreadyRunning(self.folder)
        run, stop = str(uuid.uuid4()), Event()
        self._write(run, id=run, status="running", started_at=_now(), finished_at=None, species_ids=species_ids or [], steps={}, notes=notes)

        def step(name: str, status: str) -> None:
            self._write(run, steps=self._read(run)["steps"] | {name: {"status": status, "at": _now()}})

        def work() -> None:
            self.spark.sparkContext.addJobTag(run)
            status, why = "done", notes
            try:
                Run(self.spark, self.folder).go(first, until, force, stop.is_set, step)
            except Exception as error:  # a stopped job ends with an error as well
                status, why = "failed", f"{type(error).__name__}: {str(error)[:500]}"
            if stop.is_set():
                status, why = "stopped", notes
            self._write(run, status=status, finished_at=_now(), notes=why)

        self.live[run] = _Live(stop, InheritableThread(target=work, daemon=True))
        self.live[run].thread.start()
        return run

    def stop(self, run: str, timeout: float = 60.0) -> str:
        """POST /pipeline/stop: no further step starts, and the jobs of the one that is going on are cancelled; what it wrote is not published."""
        if (own := self.live.get(run)) and own.thread.is_alive():
            own.stop.set()
            while own.thread.is_alive() and timeout > 0:  # a step may start one more job between the two
                self.spark.sparkContext.cancelJobsWithTag(run)
                own.thread.join(0.5)
                timeout -= 0.5
        return self.status(run)["status"]

    def wait(self, run: str, timeout: float | None = None) -> dict:
        if own := self.live.get(run):
            own.thread.join(timeout)
        return self.status(run)

    def status(self, run: str | None = None) -> dict:
        """GET /pipeline/status: the state of a run, by default of the one that started last."""
        states = [self._read(r) for r in ([run] if run else self.states.names(""))]
        state = max((s for s in states if s), key=lambda s: s["started_at"], default={})
        alive = state and (own := self.live.get(state["id"])) is not None and own.thread.is_alive()
        return state | {"status": "failed"} if state.get("status") == "running" and not alive else state

    def runs(self) -> DataFrame:
        """The table of runs, newest first; a run has a row."""
        rows = [self.status(r) for r in self.states.names("")]
        table = [(s["id"], s["started_at"], s["finished_at"], s["status"], s["species_ids"], s["steps"], s["notes"]) for s in rows]
        schema = "id string, started string, finished string, status string, species_ids array<string>, step_statuses map<string,struct<status:string,at:string>>, notes string"
        df = self.spark.createDataFrame(table, schema).selectExpr("*", "to_timestamp_ntz(left(started, 26)) AS started_at", "to_timestamp_ntz(left(finished, 26)) AS finished_at")
        return conform(df, "pipeline_run").orderBy("started_at", ascending=False)
