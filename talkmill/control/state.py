"""The run manifest: a small transactional store on the driver, with read-only DataFrame views."""

from __future__ import annotations

import sqlite3
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

LAYERS = ("bronze", "silver", "gold")
OPEN, DONE, FAILED, INTERRUPTED = "IN_PROGRESS", "COMPLETED", "FAILED", "INTERRUPTED"
LONGEST_ERROR = 512
# Tables and columns `batches` and `runs`, and the statuses, of the data contract.
DDL = """
CREATE TABLE IF NOT EXISTS batches (batch_id TEXT PRIMARY KEY, source_path TEXT NOT NULL, source_hash TEXT NOT NULL, source_mtime INTEGER NOT NULL,
  status TEXT NOT NULL CHECK (status IN ('IN_PROGRESS', 'COMPLETED', 'FAILED')), rows_read INTEGER, rows_written INTEGER, error TEXT, started_at TEXT NOT NULL, finished_at TEXT);
CREATE TABLE IF NOT EXISTS runs (run_id INTEGER PRIMARY KEY, batch_id TEXT NOT NULL REFERENCES batches ON DELETE CASCADE, layer TEXT NOT NULL CHECK (layer IN ('bronze', 'silver', 'gold')),
  status TEXT NOT NULL CHECK (status IN ('IN_PROGRESS', 'COMPLETED', 'FAILED')), rows_in INTEGER, rows_out INTEGER, rows_rejected INTEGER, error TEXT, started_at TEXT NOT NULL, finished_at TEXT);
CREATE INDEX IF NOT EXISTS runs_by_batch ON runs (batch_id, layer, started_at);
CREATE TABLE IF NOT EXISTS loop_runs (loop_id INTEGER PRIMARY KEY, status TEXT NOT NULL CHECK (status IN ('IN_PROGRESS', 'COMPLETED', 'FAILED', 'INTERRUPTED')), batches INTEGER, failures INTEGER, started_at TEXT NOT NULL, finished_at TEXT);
CREATE TABLE IF NOT EXISTS failures (failure_id INTEGER PRIMARY KEY, loop_id INTEGER REFERENCES loop_runs ON DELETE CASCADE, batch_id TEXT NOT NULL, layer TEXT NOT NULL, kind TEXT NOT NULL, attempt INTEGER NOT NULL, error TEXT, fix TEXT, escalated INTEGER NOT NULL DEFAULT 0, at TEXT NOT NULL);
CREATE TABLE IF NOT EXISTS replies (key TEXT PRIMARY KEY, model TEXT NOT NULL, reply TEXT NOT NULL, at TEXT NOT NULL);
CREATE TABLE IF NOT EXISTS files (path TEXT PRIMARY KEY, size INTEGER NOT NULL, mtime_ms INTEGER NOT NULL, source_hash TEXT NOT NULL);
"""
#: Columns that came later: added to a manifest made before them, whose rows keep nulls.
ADDED = {"runs": {"rows_deduped": "INTEGER", "output_path": "TEXT"}}


def now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="seconds")


class Manifest:
    """One connection for a whole process; open work of an earlier process is marked failed once, when it's opened."""

    def __init__(self, path: str):
        self.db = sqlite3.connect(path, isolation_level=None, timeout=5)
        self.db.row_factory = sqlite3.Row
        self.db.execute("PRAGMA journal_mode = WAL")
        self.db.execute("PRAGMA foreign_keys = ON")
        self.db.executescript(DDL)
        for table, columns in ADDED.items():
            there = {r["name"] for r in self.db.execute(f"PRAGMA table_info({table})")}
            for name, kind in columns.items():
                if name not in there:
                    self.db.execute(f"ALTER TABLE {table} ADD COLUMN {name} {kind}")
        for table in ("batches", "runs"):
            self.db.execute(f"UPDATE {table} SET status = 'FAILED', error = 'left open', finished_at = ? WHERE status = 'IN_PROGRESS'", (now(),))

    def close(self) -> None:
        self.db.close()

    @contextmanager
    def transaction(self):
        self.db.execute("BEGIN IMMEDIATE")
        try:
            yield self.db
        except BaseException:
            self.db.execute("ROLLBACK")
            raise
        self.db.execute("COMMIT")

    def _one(self, sql: str, *args):
        row = self.db.execute(sql, args).fetchone()
        return dict(row) if row else None

    # batches
    def open_batch(self, batch) -> None:
        """A failed batch is replaced, its runs with it."""
        with self.transaction() as db:
            db.execute("DELETE FROM batches WHERE batch_id = ? AND status = 'FAILED'", (batch.batch_id,))
            db.execute("INSERT INTO batches (batch_id, source_path, source_hash, source_mtime, status, started_at) VALUES (?, ?, ?, ?, 'IN_PROGRESS', ?)", (batch.batch_id, batch.path, batch.source_hash, batch.mtime, now()))

    def end_batch(self, batch_id: str, error: str | None = None, rows_read: int | None = None, rows_written: int | None = None) -> None:
        self.db.execute("UPDATE batches SET status = ?, error = ?, rows_read = COALESCE(?, rows_read), rows_written = COALESCE(?, rows_written), finished_at = ? WHERE batch_id = ?", (FAILED if error else DONE, error and error[:LONGEST_ERROR], rows_read, rows_written, now(), batch_id))

    def batch(self, batch_id: str) -> dict | None:
        return self._one("SELECT * FROM batches WHERE batch_id = ?", batch_id)

    # runs
    def open_run(self, batch_id: str, layer: str) -> int:
        return self.db.execute("INSERT INTO runs (batch_id, layer, status, started_at) VALUES (?, ?, 'IN_PROGRESS', ?)", (batch_id, layer, now())).lastrowid

    def end_run(self, run_id: int, error: str | None = None, output_path: str | None = None, **rows: int | None) -> None:
        counts = ("rows_in", "rows_out", "rows_rejected", "rows_deduped")
        kept = ", ".join(f"{c} = COALESCE(?, {c})" for c in (*counts, "output_path"))
        self.db.execute(f"UPDATE runs SET status = ?, error = ?, {kept}, finished_at = ? WHERE run_id = ?", (FAILED if error else DONE, error and error[:LONGEST_ERROR], *[rows.get(c) for c in counts], output_path, now(), run_id))

    def latest_run(self, batch_id: str, layer: str) -> dict | None:
        return self._one("SELECT * FROM runs WHERE batch_id = ? AND layer = ? ORDER BY started_at DESC, run_id DESC LIMIT 1", batch_id, layer)

    def completed(self, batch_id: str, layer: str) -> bool:
        run = self.latest_run(batch_id, layer)
        return bool(run) and run["status"] == DONE

    def invalidate(self, batch_id: str, layer: str, why: str) -> None:
        run = self.latest_run(batch_id, layer)
        if run:
            self.end_run(run["run_id"], error=why)

    # loop
    def open_loop(self) -> int:
        return self.db.execute("INSERT INTO loop_runs (status, started_at) VALUES ('IN_PROGRESS', ?)", (now(),)).lastrowid

    def end_loop(self, loop_id: int, batches: int, failures: int, status: str = DONE) -> None:
        self.db.execute("UPDATE loop_runs SET status = ?, batches = ?, failures = ?, finished_at = ? WHERE loop_id = ?", (FAILED if failures and status == DONE else status, batches, failures, now(), loop_id))

    def record_failure(self, loop_id: int, batch_id: str, layer: str, kind: str, error: str) -> int:
        attempt = self.attempts(batch_id, layer, kind) + 1
        return self.db.execute("INSERT INTO failures (loop_id, batch_id, layer, kind, attempt, error, at) VALUES (?, ?, ?, ?, ?, ?, ?)", (loop_id, batch_id, layer, kind, attempt, error[:LONGEST_ERROR], now())).lastrowid

    def attempts(self, batch_id: str, layer: str, kind: str) -> int:
        """Failures since the layer last completed."""
        return self._one("SELECT count(*) AS n FROM failures WHERE batch_id = ? AND layer = ? AND kind = ? AND at >= COALESCE((SELECT max(finished_at) FROM runs WHERE batch_id = ? AND layer = ? AND status = 'COMPLETED'), '')", batch_id, layer, kind, batch_id, layer)["n"]

    def stamp(self, failure_id: int, fix: str | None = None, escalated: bool = False) -> None:
        self.db.execute("UPDATE failures SET fix = COALESCE(?, fix), escalated = ? WHERE failure_id = ?", (fix, int(escalated), failure_id))

    # replies: the first writer wins
    def reply(self, key: str) -> str | None:
        row = self._one("SELECT reply FROM replies WHERE key = ?", key)
        return row and row["reply"]

    def keep_reply(self, key: str, model: str, reply: str) -> None:
        self.db.execute("INSERT OR IGNORE INTO replies VALUES (?, ?, ?, ?)", (key, model, reply, now()))

    def forget_replies(self, prefix: str) -> int:
        plain = prefix.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
        return self.db.execute("DELETE FROM replies WHERE key LIKE ? ESCAPE '\\'", (plain + "%",)).rowcount

    # hashes of source files
    def known_hash(self, path: str, size: int, mtime_ms: int) -> str | None:
        row = self._one("SELECT source_hash FROM files WHERE path = ? AND size = ? AND mtime_ms = ?", path, size, mtime_ms)
        return row and row["source_hash"]

    def keep_hash(self, path: str, size: int, mtime_ms: int, source_hash: str) -> None:
        self.db.execute("INSERT OR REPLACE INTO files VALUES (?, ?, ?, ?)", (path, size, mtime_ms, source_hash))

    def view(self, spark: SparkSession, table: str) -> DataFrame:
        """A table as a DataFrame: one row per batch, run or failure, small by nature."""
        if table not in ("batches", "runs", "loop_runs", "failures", "replies", "files"):
            raise ValueError(table)
        rows = [tuple(r) for r in self.db.execute(f"SELECT * FROM {table}")]
        info = self.db.execute(f"PRAGMA table_info({table})").fetchall()
        return spark.createDataFrame(rows, ", ".join(f"{c['name']} {'bigint' if c['type'] == 'INTEGER' else 'string'}" for c in info))
