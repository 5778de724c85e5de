"""Very long and hostile inputs, with time limits far above what the code needs."""

import time

import pytest

N = 20_000


def _timed(limit, f, *args):
    t = time.perf_counter()
    out = f(*args)
    assert time.perf_counter() - t < limit
    return out


@pytest.mark.parametrize("page", [
    "<b>" * N + "</i>" * N + "last",
    "<b>" * N + "</div>" * N + "last",
    "<b>" * N + "<hr>" * N + "last",
    "<div>x" * N + "<li>y</li>" * N + "last",
    "<b><div>" + "<i>" * N + "</b>" * N + "last",
    "<head>" * N + "last",
])
def test_op6_tags_that_match_nothing(page):
    from sparkrisk.llm.html import main_text

    assert _timed(8, main_text, page).endswith("last")


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_op8_long_words(name):
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    from sparkrisk.llm.bpe import BpeModel

    path = public_tokenizers.path(name)
    model, library = BpeModel(path), Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    rnd = random.Random(8)
    letters = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    texts = [f(n) for n in (255, 256, 257, 511, 512, 513, 1025, 3000) for f in (
        letters, lambda n: "a" * n, lambda n: ("abc" * n)[:n], lambda n: "x" * n + " hello " + "=" * n,
        lambda n: "".join(rnd.choice("etaoinäß€日") for _ in range(n)))]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in model.encode(texts)] == want
    for long, limit in ((letters(20_000), 2), ("a" * 20_000, 4), (letters(1_000_000), 60)):
        ids = _timed(limit, model.encode, [long])[0].tolist()
        assert ids == library.encode(long, add_special_tokens=False).ids


def test_batches_are_hashed_in_slices():
    """A batch's numbers are made for a bounded run of texts at a time, and are the same ones."""
    import numpy as np
    import pyarrow as pa

    from sparkrisk.llm import substring

    texts = [" ".join(f"w{(i * j) % 50}" for j in range(i * 7)) for i in range(60)] + [None, "", "x " * 3000, "ä ö"]
    column = pa.array(texts)
    runs = list(substring._slices(column, 2_000))
    assert [a for a, _ in runs] == [0, *np.cumsum([n for _, n in runs])[:-1]] and sum(n for _, n in runs) == len(texts)
    assert all(n == 1 or sum(len((t or "").encode()) for t in texts[a : a + n]) <= 2_000 for a, n in runs)
    parts = [substring._segments(column.slice(a, n), 20, 8) for a, n in runs]
    whole = substring._segments(column, 20, 8)
    for i in range(5):
        shift = [a if i == 2 else 0 for a, _ in runs]
        assert np.array_equal(np.concatenate([p[i] + p[i].dtype.type(s) for p, s in zip(parts, shift)]), whole[i])
    assert list(substring._slices(column.slice(0, 0))) == []
