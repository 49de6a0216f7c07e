"""A lease on a table: at most one run publishes at a time, across drivers.

The lease is the file with the highest number in ``<work>/<db>/<table>/_LEASE``; the number is the fencing
number. A run takes the next number with an exclusive create, which one of several runs wins, when the holder
has released its file or let it expire; a thread renews it meanwhile. Before each live file or catalog entry
is touched, the holder looks whether a higher number exists: a run that was thought dead (a long pause, a
clock that is off) finds one, stops there, and leaves the rest to the repair of its journal.
"""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import SparkSession

from keysweep.sinks import fs

SECONDS = 300.0


class LeaseError(RuntimeError):
    """Another run holds the table."""


class LeaseLost(RuntimeError):
    """Another run has taken the table over."""


def _folder(base: str) -> str:
    return f"{base}/_LEASE"


def _file(base: str, number: int) -> str:
    return f"{_folder(base)}/{number:012d}"


def _latest(spark: SparkSession, base: str) -> tuple[int, dict]:
    """The highest number and what it says; a file that is being written counts as held."""
    names = sorted(p for p in fs.list_plain_files(spark, _folder(base)) if p.rsplit("/", 1)[-1].isdigit())
    if not names:
        return 0, {"until": 0.0}
    number = int(names[-1].rsplit("/", 1)[-1])
    try:
        return number, json.loads(fs.read_text(spark, names[-1]))
    except Exception:
        return number, {"run": "unknown", "until": time.time() + 1}


class Lease:
    def __init__(self, spark: SparkSession, base: str, run_id: str, seconds: float = SECONDS):
        self.spark, self.base, self.run_id, self.seconds = spark, base, run_id, seconds
        self.number = 0
        self._stop = threading.Event()

    def _text(self, until: float) -> str:
        return json.dumps({"run": self.run_id, "app": self.spark.sparkContext.applicationId, "until": until})

    def take(self, wait: float = 0.0, poll: float = 0.5) -> "Lease":
        """Take the lease, waiting up to ``wait`` seconds for the present holder."""
        last = time.time() + wait
        while True:
            number, holder = _latest(self.spark, self.base)
            if holder.get("until", 0.0) <= time.time():
                try:
                    fs.write_text(self.spark, _file(self.base, number + 1), self._text(time.time() + self.seconds))
                    self.number = number + 1
                    break
                except Exception:
                    if not fs.exists(self.spark, _file(self.base, number + 1)):   # not a lost race: the folder cannot be written
                        raise
                    continue
            if time.time() >= last:
                raise LeaseError(f"run {holder.get('run')} publishes this table")
            time.sleep(poll)
        for old in range(max(1, self.number - 100), self.number):   # what came before is no longer asked for
            fs.delete(self.spark, _file(self.base, old))
        threading.Thread(target=self._renew, daemon=True).start()
        return self

    def _renew(self) -> None:
        while not self._stop.wait(self.seconds / 3):
            try:
                self._write(time.time() + self.seconds)
            except Exception:   # the next turn tries again; if none succeeds the lease runs out
                pass

    def _write(self, until: float) -> None:
        draft = f"{self.base}/_lease_{self.number}_{self.run_id}"
        fs.delete(self.spark, draft)
        fs.write_text(self.spark, draft, self._text(until))
        fs.replace(self.spark, draft, _file(self.base, self.number))

    def check(self) -> None:
        """Raise if another run has a higher number."""
        if fs.exists(self.spark, _file(self.base, self.number + 1)):
            raise LeaseLost(f"run {self.run_id} (number {self.number}) lost its lease; the next run goes on")

    def release(self) -> None:
        self._stop.set()
        if self.number and not fs.exists(self.spark, _file(self.base, self.number + 1)):
            self._write(0.0)
