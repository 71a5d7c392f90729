"""Texts as flat bytes: slices, words and strings against plain Python."""

import random

import numpy as np
import pyarrow as pa
import pytest
from kinomart.llm.byte_texts import EDGE, WIDTH, Places, Texts


def _texts(seed):
    rng = random.Random(seed)
    some = ["".join(rng.choice(["a", "B", "é", " ", "\n", "xyz"]) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    return ["", "w " + "q" * 50, "v" * 70, " x" * 40, *some, "", " ", "z " + "y" * 45]


@pytest.mark.parametrize("limit", [1, 7, 20, 10**6])
def test_slices_hold_every_word_and_string_once(limit):
    texts = _texts(limit)
    parts = Texts(pa.array(texts))
    lowered = [t.encode().lower() for t in texts]
    words, grams = [[] for _ in texts], [[] for _ in texts]
    for part in parts.slices(limit):
        assert (part[1] <= part[2]).all()
        for found, (values, owner) in ((words, parts.words(*part)), (grams, parts.grams(*part, 3))):
            for v, o in zip(values.tolist(), owner.tolist(), strict=True):
                found[o].append(v)
    number = {}
    for data, hashes, codes in zip(lowered, words, grams, strict=True):
        assert len(data.split()) == len(hashes)
        for w, h in zip(data.split(), hashes, strict=True):
            assert number.setdefault(w, h) == h
        symbols = [EDGE] * 3 + list(data) + [EDGE]
        assert codes == [sum(symbols[i + 3 - k] << (WIDTH * k) for k in range(4)) for i in range(len(data) + 1)]
    assert len(set(number.values())) == len(number)


def test_places_of_numbers():
    keys = np.random.default_rng(1).permutation(np.arange(-5000, 5000)) * np.int64(1 << 40)
    places = Places(keys)
    wanted = keys[::-3]
    assert (keys[places.find(wanted)] == wanted).all()
    with pytest.raises(KeyError):
        places.find(np.array([keys[0], 77]))
    assert len(Places(keys[:1]).find(keys[:0])) == 0
