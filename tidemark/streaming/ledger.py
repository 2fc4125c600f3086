"""An epoch ledger: what each batch of each run wrote, committed once per batch for all its sinks.

Layout below a root::

    <sink>/epoch=000002-000000000005/part-...   data of one batch, written before the commit
    <sink>/fold=000002-000000000009-<id>/...    several epochs folded into one
    _ledger/run-000002.json                     a run: a checkpoint folder's life
    _ledger/epoch-000002-000000000005.json      the commit: sinks written, and notes of the batch
    _ledger/fold-<sink>-000002-000000000009.json   the fold that stands for all epochs up to there

Nothing counts that the ledger doesn't name. A batch that died before its commit is written again
over its own uncommitted folder; a batch that is replayed after its commit is known and left alone. A new checkpoint
folder is a new run, and runs are ordered, so its batches, numbered from 0 again, stand behind
those of the runs before. Readers hold a list of folders; what a fold replaces is
removed only by a later fold, after a grace period.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.storage import list_names, move_new, read_text, remove_tree, write_text

_RUN = re.compile(r"^run-(\d{6,})\.json$")
_EPOCH = re.compile(r"^epoch-(\d{6,}-\d{12})\.json$")
_MARK = "ledger-run"  # beside Spark's own files in the checkpoint folder
EPOCH = "epoch"


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # Files of the ledger itself

    def _path(self, name: str) -> str:
        return f"{self.root}/_ledger/{name}"

    def _names(self) -> list[str]:
        return list_names(self.spark, f"{self.root}/_ledger")

    def _get(self, name: str) -> dict:
        return json.loads(read_text(self.spark, self._path(name)))

    def _add(self, name: str, record: dict) -> bool:
        draft = self._path(f"_draft-{uuid.uuid4().hex}")
        write_text(self.spark, draft, json.dumps(record))
        if move_new(self.spark, draft, self._path(name)):
            return True
        remove_tree(self.spark, draft)
        return False

    # Runs and epochs

    def _runs(self, names: Sequence[str] | None = None) -> dict[int, dict]:
        return {int(m.group(1)): self._get(n) for n in names or self._names() if (m := _RUN.match(n))}

    def start_run(self, checkpoint: str, replaces: bool = False) -> int:
        """Number of the run that this checkpoint folder belongs to; a new one for a new folder.

        With ``replaces`` a new run takes the place of all runs before it, as one that reads its
        topic from the beginning does; without, it goes on behind them.
        """
        mark = f"{checkpoint.rstrip('/')}/{_MARK}"
        known = read_text(self.spark, mark)
        runs = self._runs()
        for number, run in runs.items():
            if known and run["id"] == known:
                return number
        if not known:
            known = uuid.uuid4().hex
            write_text(self.spark, mark, known)
        number = max(runs, default=0) + 1
        if not self._add(f"run-{number:06d}.json", {"id": known, "replaces": replaces}):
            raise RuntimeError(f"another query started a run in {self.root}")
        return number

    def epoch(self, run: int, batch: int) -> str:
        return f"{run:06d}-{batch:012d}"

    def epochs(self, names: Sequence[str] | None = None) -> list[str]:
        """Committed epochs in order, without those of replaced runs."""
        names = self._names() if names is None else names
        since = max((n for n, run in self._runs(names).items() if run["replaces"]), default=0)
        return sorted(m.group(1) for n in names if (m := _EPOCH.match(n)) and int(m.group(1).split("-")[0]) >= since)

    def is_committed(self, epoch: str) -> bool:
        return f"epoch-{epoch}.json" in self._names()

    def record(self, epoch: str) -> dict:
        return self._get(f"epoch-{epoch}.json")

    def last(self, run: int | None = None) -> dict | None:
        """The record of the newest committed epoch (of one run)."""
        known = [e for e in self.epochs() if run is None or int(e.split("-")[0]) == run]
        return self.record(known[-1]) if known else None

    def write(self, epoch: str, sink: str, df: DataFrame) -> dict:
        """Write one sink's share of a batch; returns what :meth:`commit` must be told of it."""
        folder = f"{sink}/{EPOCH}={epoch}"
        df.write.mode("overwrite").parquet(f"{self.root}/{folder}")
        return {"folder": folder, "schema": json.loads(df.schema.json())}

    def commit(self, epoch: str, sinks: dict[str, dict], notes: dict | None = None) -> bool:
        """Make a batch count, all sinks at once. False if it counts already."""
        return self._add(f"epoch-{epoch}.json", {"sinks": sinks, "notes": notes or {}})

    # Reading

    def _state(self, sink: str) -> tuple[dict | None, list[tuple[str, dict]]]:
        """The newest fold of a sink and the (epoch, entry) pairs behind it."""
        names = self._names()
        epochs = self.epochs(names)
        first = epochs[0].split("-")[0] if epochs else ""
        pattern = re.compile(rf"^fold-{re.escape(sink)}-(\d{{6,}}-\d{{12}})\.json$")
        folds = sorted(m.group(1) for n in names if (m := pattern.match(n)) and m.group(1).split("-")[0] >= first)
        fold = self._get(f"fold-{sink}-{folds[-1]}.json") if folds else None
        entries = []
        for epoch in epochs:
            if not folds or epoch > folds[-1]:
                entry = self.record(epoch)["sinks"].get(sink)
                if entry:
                    entries.append((epoch, entry))
        return fold, entries

    def read(self, sink: str) -> DataFrame | None:
        """All committed rows of a sink with their ``epoch``; ``None`` before its first batch."""
        fold, entries = self._state(sink)
        schemas = ([fold["schema"]] if fold else []) + [e["schema"] for _, e in entries]
        if not schemas:
            return None
        out = None
        # Folders of one schema are one scan; more of them only where the query's columns changed.
        for schema in {json.dumps(s): s for s in schemas}.values():
            paths = [e["folder"] for _, e in entries if e["schema"] == schema]
            kind = T.StructType.fromJson(schema)
            frames = []
            if paths:
                reader = self.spark.read.schema(T.StructType([*kind.fields, T.StructField(EPOCH, T.StringType())]))
                frames.append(reader.option("basePath", f"{self.root}/{sink}").parquet(*[f"{self.root}/{p}" for p in paths]))
            if fold and fold["schema"] == schema:
                stored = T.StructType([*kind.fields, T.StructField("_epoch", T.StringType())])
                frames.append(self.spark.read.schema(stored).parquet(f"{self.root}/{fold['folder']}").withColumnRenamed("_epoch", EPOCH))
            for frame in frames:
                out = frame if out is None else out.unionByName(frame, allowMissingColumns=True)
        return out

    def open_epochs(self, sink: str) -> int:
        """Number of folders that no fold covers yet."""
        return len(self._state(sink)[1])

    def fold(self, sink: str, reduce: Callable[[DataFrame], DataFrame] | None = None, grace_seconds: float = 3600.0, now: float | None = None) -> int:
        """Fold the committed epochs of a sink into one folder; returns the number of folders it stands for.

        ``reduce`` maps the rows, with their ``epoch``, to fewer rows with an ``epoch``. Old folders
        stay for ``grace_seconds`` and are then removed by the next fold.
        """
        now = time.time() if now is None else now
        fold, entries = self._state(sink)
        if len(entries) + bool(fold) < 2:
            return 0
        upto = entries[-1][0]
        rows = self.read(sink)
        rows = reduce(rows) if reduce else rows
        folder = f"{sink}/fold={upto}-{uuid.uuid4().hex}"
        packed = rows.withColumnRenamed(EPOCH, "_epoch")
        # The folder's name is no column of what it holds.
        packed.hint("rebalance").write.parquet(f"{self.root}/{folder}")
        kind = T.StructType([f for f in rows.schema.fields if f.name != EPOCH])
        retired = [r for r in (fold or {}).get("retired", []) if now - r["at"] < grace_seconds]
        expired = [r["folder"] for r in (fold or {}).get("retired", []) if now - r["at"] >= grace_seconds]
        gone = [e["folder"] for _, e in entries] + ([fold["folder"]] if fold else [])
        record = {"folder": folder, "schema": json.loads(kind.json()), "retired": retired + [{"folder": g, "at": now} for g in gone]}
        if not self._add(f"fold-{sink}-{upto}.json", record):
            remove_tree(self.spark, f"{self.root}/{folder}")
            return 0
        for path in expired:
            remove_tree(self.spark, f"{self.root}/{path}")
        return len(gone)
