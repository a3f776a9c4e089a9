"""Words of a slice: the same whatever the slices, and what a worker keeps for them is small."""

import numpy as np
import pyarrow as pa

from reviewlab.llm import textkernel
from reviewlab.llm.textkernel import ALNUM, Words, slices


def hashes(column, **options):
    return np.concatenate([Words(buf, offsets, ALNUM).hash for _, _, buf, offsets in slices(column, **options)])


def test_words_are_the_same_in_slices_of_any_size():
    texts = [f"word{i} and é{i % 7} " * (i % 50) for i in range(2000)] + ["", None, "one long text " * 40_000]
    column = pa.array(texts)
    assert (hashes(column) == hashes(column, slice_bytes=1 << 22)).all()


def test_powers_kept_for_short_texts_are_small(monkeypatch):
    powers = textkernel._Powers()
    monkeypatch.setattr(textkernel, "_POWERS", powers)
    hashes(pa.array(["some words of a text " * 50] * 3000))
    assert powers.up.nbytes + powers.down.nbytes <= 4 << 20
