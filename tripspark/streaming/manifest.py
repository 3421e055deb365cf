"""Log of the batcher's micro-batches: where each one's numbers start and end, compacted as it grows.

An entry is a file of a few bytes whose name holds all of it: ``e-<end>-<start>-<stream>-<micro-batch>``, so the log is read by listing names. After
``every`` entries of a stream, all but its last two go into one table ``c-<n>``, a row for each stream (its last merged entry), and
are removed; the table before goes once the new one is complete. A restart lists at most ``every`` + 2 names of its stream and opens one
table at most, however long the run was. The last two entries stay, since a retried micro-batch asks for the entry before it.

Every step can be repeated: an entry is written under another name and renamed, a table counts only with its success mark,
and an entry that is both in the table and listed says the same.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from ..session import delete, list_dir, make_file, path_exists

SCHEMA = "stream STRING, batch_id BIGINT, start BIGINT, end BIGINT"
EVERY = 100


@dataclass(frozen=True)
class Entry:
    stream: str
    batch_id: int
    start: int
    end: int

    @property
    def name(self) -> str:
        return f"e-{self.end:020d}-{self.start:020d}-{self.stream}-{self.batch_id}"


def _entry(name: str) -> Entry:
    _, end, start, rest = name.split("-", 3)
    stream, batch_id = rest.rsplit("-", 1)
    return Entry(stream, int(batch_id), int(start), int(end))


class Manifest:
    """The log in the folder ``path``. ``opened`` counts the tables it read."""

    def __init__(self, spark: SparkSession, path: str, every: int = EVERY):
        if every < 3:
            raise ValueError("a log is compacted after three entries at least")
        self.spark, self.path, self.every, self.opened = spark, path.rstrip("/"), every, 0

    def _names(self) -> list[str]:
        return sorted(n for n, _ in list_dir(self.spark, self.path))

    def _table(self, names: list[str]) -> str | None:
        done = [n for n in names if n.startswith("c-") and path_exists(self.spark, f"{self.path}/{n}/_SUCCESS")]
        return done[-1] if done else None

    def _merged(self, names: list[str]) -> list[Entry]:
        table = self._table(names)
        if table is None:
            return []
        self.opened += 1
        rows = self.spark.read.schema(SCHEMA).json(f"{self.path}/{table}").collect()  # a row a stream
        return [Entry(r.stream, r.batch_id, r.start, r.end) for r in rows]

    def start(self, stream: str, batch_id: int) -> int:
        """The first number of a micro-batch: the end of the one before it; of a stream's first, the end of all other streams."""
        names = self._names()
        tail = [_entry(n) for n in names if n.startswith("e-")]
        before = [e.end for e in tail if e.stream == stream and e.batch_id == batch_id - 1]
        if before:
            return before[0]
        known = [*tail, *self._merged(names)]
        before = [e.end for e in known if e.stream == stream and e.batch_id == batch_id - 1]
        if before:
            return before[0]
        return max((e.end for e in known if e.stream != stream or e.batch_id < batch_id), default=0)

    def add(self, stream: str, batch_id: int, start: int, n_rows: int) -> None:
        """Log a micro-batch whose rows are written; a retry replaces its entry."""
        entry = Entry(stream, batch_id, start, start + n_rows)
        for n in self._names():
            if n.startswith("e-") and n != entry.name and (e := _entry(n)).stream == stream and e.batch_id == batch_id:
                delete(self.spark, f"{self.path}/{n}")
        make_file(self.spark, f"{self.path}/{entry.name}")
        self._compact(stream)

    def _compact(self, stream: str) -> None:
        names = self._names()
        mine = sorted((e for n in names if n.startswith("e-") and (e := _entry(n)).stream == stream), key=lambda e: e.batch_id)
        if len(mine) <= self.every:
            return
        old = [_entry(n) for n in names if n.startswith("e-") and _entry(n) not in mine[-2:]]
        last: dict[str, Entry] = {}
        for e in sorted([*self._merged(names), *old], key=lambda e: e.batch_id):
            last[e.stream] = e
        tables = [n for n in names if n.startswith("c-")]
        new = f"c-{int(tables[-1][2:]) + 1 if tables else 0:012d}"
        rows = [(e.stream, e.batch_id, e.start, e.end) for e in last.values()]
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").json(f"{self.path}/{new}")
        for n in [*tables, *(e.name for e in old)]:
            delete(self.spark, f"{self.path}/{n}")

    def end(self) -> int:
        """Rows written in all."""
        names = self._names()
        return max((e.end for e in [*(_entry(n) for n in names if n.startswith("e-")), *self._merged(names)]), default=0)
