"""Short test items, which have few shingles, in long texts."""

from __future__ import annotations

import numpy as np

from quorumlens.llm.decontaminate import Items
from tests.llm import brute


def test_no_short_item_is_missed():
    rng = np.random.default_rng(15)
    words = [f"w{k}" for k in range(3000)]
    texts = [" ".join(rng.choice(words, 400)) for _ in range(60)]
    items = []
    for text in texts:
        parts = text.split()
        for at in range(0, 380, 5):
            items.append((len(items), " ".join(parts[at : at + int(rng.integers(3, 12))])))
    block = Items(items, 5)
    found = {(i, j) for i, text in enumerate(texts) for j, _, _ in block.search(text, 0.8)}
    assert found == brute.leaks(list(enumerate(texts)), items)


def test_no_items_and_no_words():
    assert Items([], 5).search("some words of a text", 0.8) == []
    assert Items([(1, None), (2, " ")], 5).search("some words of a text", 0.8) == []
    assert Items([(1, "a b")], 5).search("", 0.8) == []
