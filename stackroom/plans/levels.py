"""Tables that grow by small additions: immutable folders in levels, and a pointer that readers follow.

An addition writes its rows to a folder of its own and then commits a state that names it. When ``fan`` folders of
one level have come together they are merged into one of the next level, so a reader meets less than ``fan``
folders per level and a row is written once per level. No folder is changed or deleted while a state that
counts names it, so a reader keeps the rows of the state it started from.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stackroom.sources.commits import Commits

FAN = 8
GENERATION = "_generation"
Merge = Callable[[Mapping[str, DataFrame], bool], Mapping[str, DataFrame]]


def rows_as_they_are(tables: Mapping[str, DataFrame], oldest: bool) -> Mapping[str, DataFrame]:
    """Merge folders by putting their rows together."""
    return {name: table.drop(GENERATION) for name, table in tables.items()}


def _last(state: dict) -> int:
    return max((f["generation"] for f in state["folders"]), default=-1)


class LeveledTables:
    """One or more tables that are added to and read together.

    Rows carry the number of the addition they came with in ``_generation``; merged folders carry the highest of theirs.
    ``merge`` gets the tables of the folders to be merged and whether the oldest rows are among them, and
    returns what the merged folder holds.
    """

    def __init__(self, spark: SparkSession, path: str, merge: Merge = rows_as_they_are, fan: int = FAN):
        self.spark, self.path, self.merge, self.fan = spark, path.rstrip("/"), merge, fan
        self.commits = Commits(spark, f"{self.path}/_states")

    def create(self, **schemas: T.StructType | str) -> LeveledTables:
        """Commit the empty tables, unless they are there already."""
        typed = {name: T.StructType.fromDDL(s) if isinstance(s, str) else s for name, s in schemas.items()}
        stated = {name: schema.jsonValue() for name, schema in typed.items()}
        self.commits.update(lambda state, _: None if state else {"schemas": stated, "folders": [], "batches": {}})
        return self

    def exists(self) -> bool:
        return self.commits.latest()[0] >= 0

    def _state(self, number: int | None = None) -> dict:
        state = self.commits.latest()[1] if number is None else self.commits.state(number)
        if not state:
            raise ValueError(f"no tables at {self.path}; create them first")
        return state

    def version(self) -> int:
        return self.commits.latest()[0]

    def folders(self, number: int | None = None) -> list[dict]:
        """Folders of a state, oldest rows first: name, level, generation."""
        return self._state(number)["folders"]

    def _write(self, tables: Mapping[str, DataFrame]) -> str:
        name = uuid.uuid4().hex
        for table, rows in tables.items():
            rows.write.parquet(f"{self.path}/{name}/{table}")
        return name

    def _read(self, state: dict, table: str, folders: list[dict]) -> DataFrame:
        schema = T.StructType.fromJson(state["schemas"][table])
        if not folders:
            return self.spark.createDataFrame([], schema).withColumn(GENERATION, F.lit(0).cast("long"))
        reads = []
        for generation in sorted({f["generation"] for f in folders}):
            paths = [f"{self.path}/{f['name']}/{table}" for f in folders if f["generation"] == generation]
            reads.append(self.spark.read.schema(schema).parquet(*paths).withColumn(GENERATION, F.lit(generation).cast("long")))
        return reduce(DataFrame.unionByName, reads)

    def read(self, table: str, number: int | None = None) -> DataFrame:
        """Rows of a table in the newest state, or that of a number, with their ``_generation``."""
        state = self._state(number)
        return self._read(state, table, state["folders"])

    def rows(self, table: str, number: int | None = None) -> DataFrame:
        """Rows of a table without generations: one scan whatever the number of folders."""
        state = self._state(number)
        schema = T.StructType.fromJson(state["schemas"][table])
        paths = [f"{self.path}/{f['name']}/{table}" for f in state["folders"]]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def batches(self) -> dict[str, int]:
        """The last numbered batch of each writer that is in the tables."""
        return self._state()["batches"]

    def last_generation(self) -> int:
        """Number of the newest addition; -1 for empty tables."""
        return _last(self._state())

    def add(self, numbered: Mapping[str, int] | None = None, after: int | None = None, **tables: DataFrame) -> bool:
        """Add rows to the tables, all at once; False when all these numbered batches of their writers are in already.

        Rows that depend on what the tables hold name the last generation they know as ``after``: they are not added, and the
        answer is False, when there is a newer one. Rows are cast to the columns of the tables. Full levels are merged
        afterwards.
        """
        numbered = dict(numbered or {})

        def is_in(current: dict) -> bool:
            return bool(numbered) and all(current["batches"].get(writer, -1) >= n for writer, n in numbered.items())

        state = self._state()
        if is_in(state):
            return False
        shaped = {}
        for name, stated in state["schemas"].items():
            schema = T.StructType.fromJson(stated)
            rows = tables.pop(name, None)
            rows = self.spark.createDataFrame([], schema) if rows is None else rows
            shaped[name] = rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        if tables:
            raise ValueError(f"unknown tables: {', '.join(sorted(tables))}")
        folder = self._write(shaped)

        def named(current: dict, number: int) -> dict | None:
            if is_in(current) or (after is not None and _last(current) != after):
                return None
            entry = {"name": folder, "level": 0, "generation": number}
            return {**current, "folders": [*current["folders"], entry], "batches": {**current["batches"], **numbered}}

        if not self._committed(folder, named):
            return False
        self.merge_full_levels()
        return True

    def merge_full_levels(self) -> None:
        """Merge the folders of each level that has ``fan`` of them, lowest level first."""
        while True:
            folders = self.folders()
            sizes = [sum(f["level"] == level for f in folders) for level in range(max((f["level"] for f in folders), default=0) + 1)]
            full = next((level for level, n in enumerate(sizes) if n >= self.fan), None)
            if full is None or not self._replace([f for f in folders if f["level"] == full], full + 1):
                return

    def compact(self) -> None:
        """Merge all folders into one."""
        folders = self.folders()
        if len(folders) > 1:
            self._replace(folders, max(f["level"] for f in folders) + 1)

    def _replace(self, merged: list[dict], level: int) -> bool:
        """Put one folder in place of some that follow each other; False when another writer has merged them."""
        state = self._state()
        names = {f["name"] for f in merged}
        oldest = not state["folders"] or state["folders"][0]["name"] in names
        tables = {name: self._read(state, name, merged) for name in state["schemas"]}
        folder = self._write(self.merge(tables, oldest))
        entry = {"name": folder, "level": level, "generation": max(f["generation"] for f in merged)}

        def swapped(current: dict, number: int) -> dict | None:
            there = [i for i, f in enumerate(current["folders"]) if f["name"] in names]
            if len(there) < len(names):
                return None
            kept = [f for f in current["folders"] if f["name"] not in names]
            return {**current, "folders": [*kept[: there[0]], entry, *kept[there[0] :]]}

        return self._committed(folder, swapped)

    def _committed(self, folder: str, change: Callable[[dict, int], dict | None]) -> bool:
        """Commit a state that names a new folder; when another writer has made it needless, the folder goes."""
        _, after = self.commits.update(change)
        named = any(f["name"] == folder for f in after["folders"])
        if not named:
            self.commits.files.delete(f"{self.path}/{folder}")
        return named

    def vacuum(self, keep: int = 2) -> None:
        """Forget all states but the last ``keep`` ones and delete the folders that only forgotten ones name.

        Folders of additions that have not been committed yet are younger than the last state; they are left alone
        when they are not listed by a forgotten state.
        """
        numbers = self.commits.numbers()
        forgotten, kept = numbers[:-keep], numbers[-keep:]
        named = {f["name"] for n in kept for f in self.commits.state(n)["folders"]}
        stale = {f["name"] for n in forgotten for f in self.commits.state(n)["folders"]} - named
        for name in stale:
            self.commits.files.delete(f"{self.path}/{name}")
        self.commits.forget(keep)
