"""Cutting Arrow batches of texts by bytes, so that a worker's memory follows a bound."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows (first, end) of about `size` bytes of text each; a longer text is alone or last."""
    if len(texts):
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // size, prepend=0))
        yield from ((a, b) for a, b in itertools.pairwise([0, *cuts, len(texts)]) if b > a)
