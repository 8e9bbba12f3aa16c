"""A worker that counts phrases holds one block's arrays: their peak is bounded."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from tidemark.llm import collocations


def test_a_block_of_texts_fits_a_worker():
    make = random.Random(1)
    text = " ".join(f"w{make.randrange(500)}" for _ in range(200_000)).encode()
    texts, langs = pa.array([text], pa.large_binary()), np.zeros(1, np.int64)
    reached = {size: np.zeros(1 << 10, np.uint8) for size in (1, 2)}
    tracemalloc.start()
    block = collocations._Block(texts, langs, ["en"])
    n = [sum(b["n"].to_pylist()) for b in block.counts(1, 2, 3, reached)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == [200_000, 200_000, 199_999, 199_998]
    # Numpy and list memory per byte of text, times a block: 468 MB with blocks of 12 MB of 64-bit numbers.
    assert peak / len(text) * collocations.BLOCK < 200 << 20, peak / len(text)
