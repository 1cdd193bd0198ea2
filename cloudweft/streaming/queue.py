"""A leased message queue as a stream source.

Pulled messages are leased and cannot be read again by offset, so each pull is written to a log before it is offered; a
range of offsets is replayed from the log, and leases are acknowledged when the engine commits the range.

``FolderQueue`` is a queue in a folder, for tests and single machines. Other queues need the same three methods.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

#: Messages of a pull, and milliseconds until an unacknowledged one is offered again.
BATCH = 1
VISIBILITY_MS = 30_000


@dataclass(frozen=True)
class Message:
    body: str
    lease_id: str


class FolderQueue:
    """Files in ``pending`` are messages; a lease is a name in ``leased`` with the time at which it ends."""

    def __init__(self, folder: str | Path) -> None:
        self.pending, self.leased = Path(folder) / "pending", Path(folder) / "leased"
        for d in (self.pending, self.leased):
            d.mkdir(parents=True, exist_ok=True)

    def send(self, body: str) -> None:
        name = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        temp = self.pending / f".{name}"
        temp.write_text(body, encoding="utf-8")
        os.replace(temp, self.pending / name)

    def pull(self, batch: int = BATCH, visibility_ms: int = VISIBILITY_MS) -> list[Message]:
        now = time.time_ns() // 1_000_000
        for file in list(self.leased.iterdir()):
            ends, _, name = file.name.partition("~")
            if int(ends) <= now:
                self._moved(file, self.pending / name)
        out = []
        for file in sorted(f for f in self.pending.iterdir() if not f.name.startswith(".")):
            lease = f"{now + visibility_ms}~{file.name}"
            if len(out) < batch and self._moved(file, self.leased / lease):
                out.append(Message((self.leased / lease).read_text(encoding="utf-8"), lease))
        return out

    @staticmethod
    def _moved(file: Path, to: Path) -> bool:
        """Whether this worker moved the file, and not another one before it."""
        try:
            os.replace(file, to)
        except FileNotFoundError:
            return False
        return True

    def ack(self, lease_id: str) -> None:
        (self.leased / lease_id).unlink(missing_ok=True)


class QueueReader(SimpleDataSourceStreamReader):
    def __init__(self, folder: str, log: str, batch: int, visibility_ms: int) -> None:
        self.queue, self.log, self.batch, self.visibility_ms = FolderQueue(folder), Path(log), batch, visibility_ms
        self.log.mkdir(parents=True, exist_ok=True)

    def _entry(self, at: int) -> Path:
        return self.log / f"{at:012d}.json"

    def initialOffset(self) -> dict:
        return {"at": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        at = start["at"]
        # An entry that was offered before is offered again; a committed one is never asked for.
        if self._entry(at).exists():
            return self._rows(at), {"at": at + 1}
        pulled = self.queue.pull(self.batch, self.visibility_ms)
        if not pulled:
            return iter([]), start
        temp = self._entry(at).with_suffix(".tmp")
        temp.write_text(json.dumps([[m.body, m.lease_id] for m in pulled]), encoding="utf-8")
        os.replace(temp, self._entry(at))
        return self._rows(at), {"at": at + 1}

    def _rows(self, at: int) -> Iterator[tuple]:
        return iter([tuple(x) for x in json.loads(self._entry(at).read_text(encoding="utf-8"))])

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        for at in range(start["at"], end["at"]):
            yield from self._rows(at)

    def commit(self, end: dict) -> None:
        """Acknowledges the leases of the entries before ``end``, the last first. An entry goes once its leases are
        acknowledged, so the first one that is gone ends the way back, and the log holds uncommitted entries only."""
        done = []
        for at in range(end["at"] - 1, -1, -1):
            if not (file := self._entry(at)).exists():
                break
            done.append(file)
        for file in reversed(done):
            for _, lease in json.loads(file.read_text(encoding="utf-8")):
                self.queue.ack(lease)
        for file in done[::-1]:
            file.unlink(missing_ok=True)


class QueueSource(DataSource):
    """Options: folder, log, batch, visibility_ms."""

    @classmethod
    def name(cls) -> str:
        return "leased_queue"

    def schema(self) -> str:
        return "body string, lease_id string"

    def simpleStreamReader(self, schema) -> QueueReader:
        o = self.options
        return QueueReader(o["folder"], o["log"], int(o.get("batch", BATCH)), int(o.get("visibility_ms", VISIBILITY_MS)))
