"""External programs over chunks of records: Spark deals the records, a task runs the program on its chunk.

A program that fails fails its task, which Spark retries; a chunk is never dropped silently.
"""

from __future__ import annotations

import shutil
import subprocess
from collections import defaultdict
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_tools(names: Iterable[str]) -> list[str]:
    return [n for n in names if shutil.which(n) is None]


def run_on_chunks(records: DataFrame, command: list[str], records_per_chunk: int, order: str | None = None) -> DataFrame:
    """Standard output lines (``value``) of ``command`` fed with chunks of the ``value`` lines of ``records``.

    About ``records_per_chunk`` records a chunk; the count of records is taken first.
    """
    chunks = max(1, -(-records.count() // records_per_chunk))
    dealt = records.repartition(chunks) if order is None else records.repartitionByRange(chunks, order).sortWithinPartitions(order)

    def call(batches):
        import pandas as pd

        text = [v for pdf in batches for v in pdf["value"]]
        if text:
            done = subprocess.run(command, input="\n".join(text) + "\n", capture_output=True, text=True)
            if done.returncode:
                raise RuntimeError(f"{command[0]} ended with {done.returncode}: {done.stderr[-2000:]}")
            yield pd.DataFrame({"value": done.stdout.splitlines()})

    return dealt.select("value").mapInPandas(call, "value string")


def merge_groups(paths: list[str]) -> dict[str, list[str]]:
    """Files by the second dot-separated part of their base name; groups of one need no merge. Nothing is deleted."""
    groups = defaultdict(list)
    for p in paths:
        parts = p.rsplit("/", 1)[-1].split(".")
        if len(parts) > 2:
            groups[parts[1]].append(p)
    return {k: sorted(v) for k, v in groups.items() if len(v) > 1}


def chunk_names(total: int) -> list[str]:
    """Chunk arguments i/N of a program that splits its input itself."""
    return [f"{i}/{total}" for i in range(1, total + 1)]


def nonempty(df: DataFrame) -> bool:
    """Whether an input has any record; steps skip empty inputs."""
    return not df.limit(1).select(F.lit(1)).isEmpty()
