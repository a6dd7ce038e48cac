"""Rows of one key of a batch in order, without holding them all.

A stream's batch may be far larger than a Python worker's memory, and what a
keyed state gets of it has no order. Beyond ``ROWS`` rows, sorted runs go to
the task's temporary folder and are read back side by side, ``BLOCK`` rows of
each at a time.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa

ROWS, BLOCK = 100_000, 2048


def _sorted(parts: list[pd.DataFrame], keys: list[str]) -> pd.DataFrame:
    return pd.concat(parts, ignore_index=True).sort_values(keys, kind="stable", ignore_index=True)


def in_order(parts: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The rows by ``keys``, equal ones as they came, in parts; rows of the same first key are in one part.

    All rows have been read when the first part comes.
    """
    held, number, runs = [], 0, []
    with tempfile.TemporaryDirectory(prefix="runs-") as folder:

        def spill() -> None:
            rows = pa.Table.from_pandas(_sorted(held, keys), preserve_index=False)
            path = os.path.join(folder, str(len(runs)))
            with pa.OSFile(path, "wb") as out, pa.ipc.new_file(out, rows.schema) as writer:
                writer.write_table(rows, max_chunksize=BLOCK)
            runs.append(path)
            held.clear()

        for part in parts:
            held.append(part)
            number += len(part)
            if number >= ROWS:
                spill()
                number = 0
        if runs:
            if number:
                spill()
            yield from _merged([_blocks(path) for path in runs], keys)
        elif number:
            yield _sorted(held, keys)


def _blocks(path: str) -> Iterator[pd.DataFrame]:
    with pa.OSFile(path, "rb") as file, pa.ipc.open_file(file) as run:
        for at in range(run.num_record_batches):
            yield run.get_batch(at).to_pandas()


def _merged(runs: list[Iterator[pd.DataFrame]], keys: list[str]) -> Iterator[pd.DataFrame]:
    first = keys[0]
    held = [next(run) for run in runs]
    more = set(range(len(runs)))
    while more:
        # What is still to come of a run is not below the last row that is here.
        ends = {r: held[r][first].iloc[-1] for r in more}
        bound = min(ends.values())
        cuts = [int(rows[first].searchsorted(bound)) for rows in held]
        if any(cuts):
            yield _sorted([rows.iloc[:cut] for rows, cut in zip(held, cuts)], keys)
            held = [rows.iloc[cut:] for rows, cut in zip(held, cuts)]
        for r in [r for r, end in ends.items() if end == bound]:
            block = next(runs[r], None)
            if block is None:
                more.discard(r)
            else:
                held[r] = pd.concat([held[r], block], ignore_index=True)
    if any(map(len, held)):
        yield _sorted(held, keys)
