"""Faults to put into stored partitions and source files."""

from pathlib import Path

import pandas as pd


def add_column(path: str) -> None:
    t = pd.read_parquet(path)
    t["surplus"] = "x"
    t.to_parquet(path)


def odd_body(path: str, body: str = "\x00 odd �") -> None:
    t = pd.read_parquet(path)
    t.loc[t.index[:1], "message_body"] = body
    t.to_parquet(path)


def append_row(path: str, **values) -> None:
    t = pd.read_parquet(path)
    pd.concat([t, t.head(1).assign(**values)], ignore_index=True).to_parquet(path)


def truncate(path: str) -> None:
    data = Path(path).read_bytes()
    Path(path).write_bytes(data[: len(data) // 2])
