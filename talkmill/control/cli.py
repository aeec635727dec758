"""python -m talkmill.control.cli ingest|silver|gold|run-once|run-forever"""

from __future__ import annotations

import argparse
import os
import re
import sys
import threading

from talkmill.control import layers, loop
from talkmill.control.state import Manifest
from talkmill.session import local_session
from talkmill.sources.batches import discover, identify


def _batch(text: str) -> str:
    if not re.fullmatch(r"[0-9a-f]{12}", text):
        raise argparse.ArgumentTypeError("a batch id has 12 hex digits")
    return text


def main(argv: list[str] | None = None, spark=None) -> int:
    p = argparse.ArgumentParser(prog="talkmill")
    p.add_argument("--source", required=True, help="folder of raw parquet files")
    p.add_argument("--root", required=True, help="folder of the tables")
    p.add_argument("--control", default="", help="folder on this disk for the manifest, lock and logs; the root unless given")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("ingest").add_argument("file")
    for name in ("silver", "gold"):
        sub.add_parser(name).add_argument("--batch-id", type=_batch, required=True)
    sub.add_parser("run-once")
    sub.add_parser("run-forever").add_argument("--passes", type=int)
    a = p.parse_args(argv)
    settings = layers.Settings(a.source, a.root, control=a.control)
    spark = spark or local_session("*", 8)
    os.makedirs(settings.control, exist_ok=True)
    manifest = Manifest(f"{settings.control}/manifest.db")
    try:
        if a.command == "ingest":
            batch = identify(a.file)
            if manifest.completed(batch.batch_id, "bronze"):
                print(f"{batch.batch_id} is there already")
                return 0
            print(batch.batch_id, layers.run_layer(spark, settings, manifest, batch, "bronze"))
        elif a.command in ("silver", "gold"):
            batch = next((b for b in discover(a.source, spark, manifest) if b.batch_id == a.batch_id), None)
            if batch is None:
                print(f"no source file of batch {a.batch_id}", file=sys.stderr)
                return 1
            print(layers.run_layer(spark, settings, manifest, batch, a.command))
        elif a.command == "run-once":
            done = loop.run_once(spark, settings, manifest)
            print(done)
            return 1 if done.failures else 0
        else:
            loop.run_forever(spark, settings, manifest, threading.Event(), a.passes)
        return 0
    finally:
        manifest.close()


if __name__ == "__main__":
    sys.exit(main())
