"""Block tables: documents gathered into rows of a few MB of compressed text.

A block is one row, so a later step gets it whole whatever the file splits
are, and block numbers never change.  Blocks are cut in a map-only pass.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.llm.common import ids, stage, utf8

BLOCK_BYTES = 4 << 20
BLOCK = "block long, ids binary, sizes binary, side binary, text binary"


def build(docs: DataFrame, name: str, side: Callable[[np.ndarray, np.ndarray], bytes] | None = None,
          doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A written table of blocks; ``side(raw, at)`` may add bytes of its own. A longer document is a block of its own."""

    def cut(batches):
        press = zstandard.ZstdCompressor(level=3).compress
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            own = ids(batch.column(0))
            raw, at = utf8(batch.column(1))
            first = 0
            while first < len(own):
                last = max(first + 1, int(np.searchsorted(at, at[first] + block_bytes, "right")) - 1)
                last = min(last, len(own))
                here, cuts = raw[at[first]:at[last]], at[first:last + 1] - at[first]
                yield pa.record_batch([
                    pa.array([number], pa.int64()), pa.array([own[first:last].tobytes()], pa.binary()),
                    pa.array([np.diff(cuts).tobytes()], pa.binary()),
                    pa.array([side(here, cuts) if side else None], pa.binary()),
                    pa.array([press(here.tobytes())], pa.binary())], names=["block", "ids", "sizes", "side", "text"])
                number, first = number + 1, last

    return stage(docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(cut, BLOCK), name)


def opened(block) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Block number, doc ids, text bytes and offsets of a one-row table or batch."""
    row = block.slice(0, 1).to_pylist()[0]
    sizes = np.frombuffer(row["sizes"], np.int64)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["text"], max_output_size=int(sizes.sum()) + 1), np.uint8)
    return row["block"], np.frombuffer(row["ids"], np.int64), raw, np.concatenate([[0], np.cumsum(sizes)])


def each(batches):
    """The blocks of Arrow batches, one by one."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1)
