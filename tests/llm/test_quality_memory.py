"""What a block's n-grams need of a task's memory beside the block's own text."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa

from ledgerflow.llm import kn_quality


def _texts() -> list[str]:
    rnd = random.Random(7)
    words = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(2, 9))) for _ in range(300)]
    return [" ".join(rnd.choices(words, k=3_000)) for _ in range(150)]


def test_grams_of_a_block_fit_a_task():
    texts = _texts()
    column = pa.chunked_array([texts])
    assert sum(map(len, texts)) > 2_000_000
    found: Counter = Counter()
    tracemalloc.start()
    for _, some in kn_quality.text_slices(column):
        g = kn_quality.Grams(some, kn_quality.ORDER)
        np.bincount(np.repeat(np.arange(len(some)), g.sizes), np.ones(len(g.grams))[g.which], len(some))
        del g
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6, f"{peak / 1e6:.0f} MB"
    for _, some in kn_quality.text_slices(column):
        g = kn_quality.Grams(some, kn_quality.ORDER)
        found.update({x: n for x, n in zip(g.grams, g.counts.tolist(), strict=True) if n})
    whole = Counter()
    for t in texts:
        padded = kn_quality.PAD * (kn_quality.ORDER - 1) + t
        whole.update(padded[i:i + kn_quality.ORDER] for i in range(len(t)))
    assert found == whole
