"""State of a micro-batch job as a log of generations.

A batch appends one generation, of the rows it adds, and a manifest that lists the
generations which are the state after it. Nothing that an earlier manifest lists is
changed, so a retried batch starts from the same state and replaces only what
it wrote itself. What a batch writes follows the batch; older rows are written
again only when generations are merged:

* small ones of one level, once there are ``fanout`` of them, into one of the next
  level, so a row is rewritten about log(batches) times at most;
* with ``live``, all of them, without the rows that are dead, once as many rows were added
  as the last such merge had left, so the state is at most about twice what lives;
* with ``capacity``, the oldest are forgotten as soon as the newer ones alone
  hold that many rows (first in, first out), and none of more than an eighth of that
  is merged.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocktide.session import child_names, delete_path, path_exists, read_text, write_text

#: The level of a merge of everything.
BASE = -1
#: Additions that a merge of everything waits for, at least.
FEWEST = 4


class LogState:
    def __init__(
        self,
        path: str,
        schema: T.StructType,
        fanout: int = 8,
        capacity: int | None = None,
        merge: Callable[[DataFrame], DataFrame] | None = None,
        order: tuple[str, ...] = (),
    ):
        """``merge`` combines rows when generations are merged; ``order`` sorts within files,
        so that readers skip row groups by the range they ask for."""
        self.path = path
        self.schema = schema
        self.fanout = fanout
        self.capacity = capacity
        self.merge = merge
        self.order = order

    def _manifest(self, spark: SparkSession, batch_id: int) -> list[dict]:
        path = f"{self.path}/manifest-{batch_id}.json"
        if batch_id < 0 or not path_exists(spark, path) and not child_names(spark, self.path, "manifest-*.json"):
            return []
        return json.loads(read_text(spark, path))

    def _load(self, spark: SparkSession, generations: list[dict]) -> DataFrame:
        folders = [f"{self.path}/{g['name']}" for g in generations]
        if not folders:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*folders)

    def read(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The state after a batch: empty before the first one, an error if one is missing later."""
        return self._load(spark, self._manifest(spark, batch_id))

    def latest(self, spark: SparkSession) -> int:
        """The last batch that has a state, -1 without any."""
        names = child_names(spark, self.path, "manifest-*.json")
        return max((int(name[len("manifest-") : -len(".json")]) for name in names), default=-1)

    def rows(self, spark: SparkSession, batch_id: int) -> int:
        return sum(g["rows"] for g in self._manifest(spark, batch_id))

    def _write(self, df: DataFrame, name: str, level: int) -> dict:
        size = Observation()
        typed = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        if self.order:
            typed = typed.sortWithinPartitions(*self.order)
        typed.observe(size, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{self.path}/{name}")
        return {"name": name, "level": level, "rows": size.get.get("rows", 0)}

    def append(self, fresh: DataFrame, batch_id: int) -> None:
        """Add the rows of a batch; they are the last generation of the state after it."""
        spark = fresh.sparkSession
        before = self._manifest(spark, batch_id - 1)
        added = self._write(fresh, f"g{batch_id}-0", 0)
        self._commit(spark, [*before, added] if added["rows"] else before, batch_id)

    def compact(
        self,
        spark: SparkSession,
        batch_id: int,
        live: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        """Merge, forget and clean up after ``batch_id`` was appended and used.

        ``live`` keeps the rows of the state that later batches can still need.
        """
        now = self._manifest(spark, batch_id)
        listed = {g["name"] for g in now}
        if self.capacity is not None:
            now = self._remembered(now)
        base = sum(g["rows"] for g in now if g["level"] == BASE)
        added = [g for g in now if g["level"] != BASE]
        if live is not None and len(added) >= FEWEST and sum(g["rows"] for g in added) >= base:
            rows = live(self._load(spark, now))
            kept = self._write(self.merge(rows) if self.merge else rows, f"g{batch_id}-base", BASE)
            now = [kept] if kept["rows"] else []
        now, made = self._tiered(spark, now, batch_id)
        self._commit(spark, now, batch_id)
        for name in made - {g["name"] for g in now} - listed:
            delete_path(spark, f"{self.path}/{name}")
        self._clean(spark, batch_id)

    def _remembered(self, generations: list[dict]) -> list[dict]:
        newer = 0
        for n in range(len(generations), 0, -1):
            if newer >= self.capacity:
                return generations[n:]
            newer += generations[n - 1]["rows"]
        return generations

    def _tiered(
        self, spark: SparkSession, generations: list[dict], batch_id: int
    ) -> tuple[list[dict], set[str]]:
        """The generations after merges by level, and the names of those that were made."""
        out, made = list(generations), set()
        most = None if self.capacity is None else max(1, self.capacity // 8)
        level = 0
        while any(g["level"] >= level for g in out):
            # Neighbours only, so that generations stay in order of age.
            same = [n for n, g in enumerate(out) if g["level"] == level]
            if len(same) >= self.fanout and same == list(range(same[0], same[-1] + 1)):
                some = out[same[0] : same[-1] + 1]
                if most is None or sum(g["rows"] for g in some) <= most:
                    rows = self._load(spark, some)
                    merged = self._write(
                        self.merge(rows) if self.merge else rows, f"g{batch_id}-{level + 1}", level + 1
                    )
                    out[same[0] : same[-1] + 1] = [merged]
                    made.add(merged["name"])
            level += 1
        return out, made

    def _commit(self, spark: SparkSession, generations: list[dict], batch_id: int) -> None:
        write_text(spark, f"{self.path}/manifest-{batch_id}.json", json.dumps(generations))

    def _clean(self, spark: SparkSession, batch_id: int) -> None:
        """Delete what neither the next batch nor a retry of this one can read."""
        old = f"{self.path}/manifest-{batch_id - 2}.json"
        if batch_id < 2 or not path_exists(spark, old):  # done by an earlier try
            return
        needed = {g["name"] for n in (batch_id - 1, batch_id) for g in self._manifest(spark, n)}
        for g in self._manifest(spark, batch_id - 2):
            if g["name"] not in needed:
                delete_path(spark, f"{self.path}/{g['name']}")
        delete_path(spark, old)
