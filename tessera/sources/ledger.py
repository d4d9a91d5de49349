"""The ledger of a history folder: which rolls make it up, and for which dates.

A version of the ledger is a small JSON file ``_ledger/<number>.json`` that
lists all rolls with their date intervals ``[start, end)``. It is published
by renaming a finished draft to the next free number, which fails if another
job took that number; readers use the highest one. So a roll is either part
of the history as a whole or not at all, and two jobs cannot both extend it.
Folders that only versions before the previous one name are removed.

Intervals follow each other: each roll begins on the day on which the one
before ends, so no row is left out and none is held twice.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.sources.files import PathTaken, SharedFiles

FOLDER = "_ledger"
OLD_ROLL = "rolled_to="
ROLL = "roll="


def as_date(value: str | _dt.date) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    return _dt.date.fromisoformat(value) if isinstance(value, str) else value


@dataclass(frozen=True)
class Roll:
    """Rows of ``[start, end)`` in ``folder``; null bounds are open.

    A roll without a ``schema`` is adopted: its folder (``""``: the plain part
    of the history) may hold further rows, which its bounds leave out.
    """

    folder: str
    start: _dt.date | None
    end: _dt.date | None
    schema: str | None = None

    @property
    def struct(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))

    def within(self, df: DataFrame, date_col: str) -> DataFrame:
        """The rows inside the bounds; rows without a date stay."""
        when = F.col(f"`{date_col}`")
        if self.start is not None:
            df = df.where(when.isNull() | (when >= F.lit(self.start)))
        if self.end is not None:
            df = df.where(when.isNull() | (when < F.lit(self.end)))
        return df

    def to_json(self) -> dict:
        return {"folder": self.folder, "start": self.start and str(self.start), "end": self.end and str(self.end),
                "schema": self.schema}

    @staticmethod
    def from_json(d: dict) -> Roll:
        return Roll(d["folder"], d["start"] and as_date(d["start"]), d["end"] and as_date(d["end"]), d["schema"])


class HistoryLedger:
    """The rolls of one history folder, in date order, and the version they were read from."""

    def __init__(self, spark: SparkSession, path: str, date_col: str | None, rolls: list[Roll], version: int) -> None:
        self.spark, self.path, self.date_col = spark, path.rstrip("/"), date_col
        self.rolls, self.version = rolls, version
        self.files = SharedFiles(spark, path)

    # ------------------------------------------------------------------
    # reading
    # ------------------------------------------------------------------
    @classmethod
    def open(cls, spark: SparkSession, path: str, date_col: str | None = None,
             start: str | _dt.date | None = None) -> HistoryLedger:
        """The ledger at ``path``, or what :meth:`adopt` makes of a folder without one."""
        files = SharedFiles(spark, path)
        versions = _versions(files)
        if not versions:
            return cls(spark, path, date_col, [], 0).adopt(start)
        found = json.loads(files.read_text(f"{FOLDER}/{versions[-1]:08d}.json"))
        return cls(spark, path, found["date_col"], [Roll.from_json(r) for r in found["rolls"]], versions[-1])

    def adopt(self, start: str | _dt.date | None = None) -> HistoryLedger:
        """Rolls for a folder that has no ledger, without writing one.

        Plain files become a roll that is open to the past; folders
        ``rolled_to=<date>`` of the older layout follow it by date, each from
        the end of the one before, so that rows which overlapping rolls held
        twice are read once. The plain part ends where what follows begins:
        ``start`` if given, else the first date of the oldest such folder,
        else (only plain files) nowhere yet.
        """
        names = [n for n in self.files.names() if not n.startswith(("_", ".", ROLL))]
        old = [n for n in names if n.startswith(OLD_ROLL)]
        plain = len(names) > len(old)
        if not old and not plain:
            return self
        if old and self.date_col is None:
            raise ValueError(f"the history at {self.path} mixes layouts: its date column must be named")
        at = None
        if plain and old:
            first = self.adopted_rows(Roll(old[0], None, None)).agg(F.min(F.col(f"`{self.date_col}`"))).first()[0]
            at = as_date(first) if first is not None else as_date(old[0][len(OLD_ROLL):])
        elif plain and start is not None:
            at = as_date(start)
        if plain:
            self.rolls.append(Roll("", None, at))
        for name in old:
            end = as_date(name[len(OLD_ROLL):])
            self.rolls.append(Roll(name, self.rolls[-1].end if self.rolls else None, end))
        return self

    def adopted_rows(self, roll: Roll) -> DataFrame:
        """All rows in the folder of an adopted roll."""
        if roll.folder:
            return self.spark.read.option("basePath", self.path).parquet(f"{self.path}/{roll.folder}")
        mine = [n for n in self.files.names() if not n.startswith(("_", ".", ROLL, OLD_ROLL))]
        # the files are named one by one: beside folders like "roll=..." Spark would leave them out
        return self.spark.read.option("basePath", self.path).parquet(*[f"{self.path}/{n}" for n in mine])

    @property
    def is_plain(self) -> bool:
        """No ledger, and nothing but plain files (or nothing at all)."""
        return not self.version and all(not r.folder for r in self.rolls)

    @property
    def end(self) -> _dt.date | None:
        return self.rolls[-1].end if self.rolls else None

    # ------------------------------------------------------------------
    # extending
    # ------------------------------------------------------------------
    def start_of(self, end: _dt.date) -> _dt.date | None:
        """Where a roll that ends at ``end`` begins: as an equal roll does, else where the history ends."""
        for roll in self.rolls:
            if roll.end == end and roll.schema is not None:
                return roll.start
        if self.rolls and self.end is None:  # a plain part without an end: the day after its last row
            last = self.adopted_rows(self.rolls[-1]).agg(F.max(F.col(f"`{self.date_col}`"))).first()[0]
            if last is None:
                raise ValueError(f"the history at {self.path} holds no dated row: name the roll's start")
            self.rolls[-1] = replace(self.rolls[-1], end=as_date(last) + _dt.timedelta(days=1))
        return self.end

    def _replaced(self, start: _dt.date | None, end: _dt.date) -> list[Roll]:
        return [r for r in self.rolls if (r.start, r.end) == (start, end) and r.schema is not None]

    def check(self, start: _dt.date | None, end: _dt.date) -> None:
        """Refuse an interval that would leave a gap or overlap a roll."""
        if start is not None and start >= end:
            raise ValueError(f"a roll from {start} to {end} holds no day")
        if not self.rolls or self._replaced(start, end):
            return
        if start is None or start < self.end:
            raise ValueError(f"a roll from {start} to {end} overlaps the history at {self.path}, which ends at {self.end}")
        if start > self.end:
            raise ValueError(f"a roll from {start} to {end} leaves a gap: the history at {self.path} ends at {self.end}")

    def publish(self, roll: Roll) -> None:
        """Make ``roll`` part of the history, in place of one of the same interval; all or nothing."""
        replaced = self._replaced(roll.start, roll.end)
        rolls = [roll if r in replaced else r for r in self.rolls] + ([] if replaced else [roll])
        text = json.dumps({"date_col": self.date_col, "rolls": [r.to_json() for r in rolls]}, indent=1)
        number = self.version + 1
        try:
            self.files.publish_text(f"{FOLDER}/{number:08d}.json", f"{FOLDER}/.draft-{uuid.uuid4().hex}", text)
        except PathTaken as taken:
            self.files.remove(roll.folder)
            raise RuntimeError(f"another job extended the history at {self.path}; nothing was added") from taken
        self._remove_unnamed(number, {r.folder for r in rolls + self.rolls})
        self.rolls, self.version = rolls, number

    def _remove_unnamed(self, number: int, named: set[str]) -> None:
        """Remove rolls that were replaced before the previous version; its readers may still be at work."""
        name = f"{FOLDER}/{number - 2:08d}.json"
        if number > 2 and name.rpartition("/")[2] in self.files.names(FOLDER):
            for old in json.loads(self.files.read_text(name))["rolls"]:
                if old["folder"].startswith(ROLL) and old["folder"] not in named:
                    self.files.remove(old["folder"])


def _versions(files: SharedFiles) -> list[int]:
    return sorted(int(n[:-5]) for n in files.names(FOLDER) if n.endswith(".json") and n[:-5].isdigit())
