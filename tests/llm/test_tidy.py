import os
import re

import numpy as np
import pyarrow as pa

from auric.llm.common import tidy
from auric.llm.wordhash import SLICE_BYTES, slices, words


def _held() -> float:
    with open(f"/proc/{os.getpid()}/status") as f:
        return int(re.search(r"VmRSS:\s+(\d+)", f.read())[1]) / 1024


def test_a_task_that_ended_holds_no_memory():
    def task(batches):
        for b in batches:
            kept = [bytes(20_000) + b"x" for _ in range(10_000)]        # 200 MB in pieces that lie in the heap
            pin = bytes(20_000) + b"y"                                   # on top of them
            del kept
            yield b, pin
    before = _held()
    assert len(pins := list(tidy(task)(iter([1])))) == 1
    assert _held() - before < 50, pins[0][0]


def test_words_of_texts_without_a_gap():
    texts = [b"", b"ab", b"cd ef", b"", b"\n gh\n\nij", b" ", b"", b"k\n", b"l", b""]
    row, line, h = words(pa.array(texts, pa.binary()))
    want = [(i, n, w) for i, t in enumerate(texts) for n, part in enumerate(t.split(b"\n")) for w in part.split()]
    assert list(zip(row.tolist(), line.tolist())) == [(i, n) for i, n, _ in want]
    alone = np.concatenate([words(pa.array([w], pa.binary()))[2] for _, _, w in want])
    assert (h == alone).all()
    assert SLICE_BYTES <= 1 << 18
    batch = pa.record_batch([pa.array([b"x" * 100_000] * 9, pa.binary())], ["text"])
    assert sum(b.num_rows for b in slices(batch)) == 9 and max(b["text"].nbytes for b in slices(batch)) <= (1 << 18) + 200_000
