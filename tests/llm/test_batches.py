import re
import tracemalloc

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lagloom.llm.batches import GOLDEN, hash_spans, in_row, lowered, mix64, pieces, texts_of, window_hashes, words_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab A\t\n\x0b\x85 é日", max_size=40)), max_size=12)


def batch(values):
    return pa.record_batch([pa.array(values, pa.string())], names=["text"])


@given(texts)
@settings(max_examples=150, deadline=None)
def test_words_are_those_of_the_pattern(values):
    found = words_of(texts_of(batch(values)))
    want = [WORD.findall(v or "") for v in values]
    assert np.diff(found.rows).tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    by_hash = {}
    for word, value in zip(flat, found.hashes.tolist()):
        assert by_hash.setdefault(value, word) == word
    assert len(by_hash) == len(set(flat))


def test_lower_case_is_ascii_only():
    found = words_of(texts_of(batch(["ÄB äb Äb"])), lower=True).hashes
    assert found[0] == found[2] != found[1]


def test_every_byte_is_lowered_as_ascii():
    assert lowered(np.arange(256, dtype=np.uint8)).tolist() == [b + 32 if 65 <= b <= 90 else b for b in range(256)]


@given(st.lists(st.tuples(st.integers(0, 2), st.one_of(st.integers(1, 12), st.integers(30, 90))), max_size=12), st.integers(0, 99))
@settings(max_examples=100, deadline=None)
def test_span_hash_is_the_sum_over_its_bytes(spans, seed):
    starts = np.array([sum(g + n for g, n in spans[:i]) + spans[i][0] for i in range(len(spans))], dtype=np.int64)
    ends = starts + np.array([n for _, n in spans], dtype=np.int64)
    data = np.random.default_rng(seed).integers(0, 256, int(ends[-1]) if spans else 0).astype(np.uint8)

    def mixed(values):
        return mix64(np.array(values, dtype=np.uint64)).tolist()

    def value(place, byte):
        return mixed([(place * 256 + byte + 1) * int(GOLDEN) % 2**64])[0]

    sums = [sum(value(i, b) for i, b in enumerate(data[a:e].tolist())) for a, e in zip(starts, ends)]
    want = mixed([(total + int(n) * int(GOLDEN)) % 2**64 for total, n in zip(sums, ends - starts)])
    assert hash_spans(data, starts, ends).tolist() == want


def test_hashing_holds_numbers_for_words_not_for_bytes():
    starts = np.arange(0, 1 << 20, 16)
    data = np.full(1 << 20, 97, dtype=np.uint8)
    tracemalloc.start()
    hash_spans(data, starts, starts + 15)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * len(data)


@given(st.lists(st.integers(0, 2**64 - 1), max_size=30), st.integers(1, 21))
@settings(max_examples=100, deadline=None)
def test_window_hash_is_the_polynomial(values, size):
    base = 0xD6E8FEB86659FD93
    want = [sum(v * pow(base, size - 1 - k, 2**64) for k, v in enumerate(values[i : i + size])) % 2**64 for i in range(len(values) - size + 1)]
    got = window_hashes(np.array(values, dtype=np.uint64), size)
    assert got.tolist() == mix64(np.array(want, dtype=np.uint64)).tolist()


def test_windows_stay_in_their_row():
    assert in_row(np.array([0, 3, 3, 5]), 2).tolist() == [True, True, False, True]


@given(texts, st.integers(1, 30))
@settings(max_examples=60, deadline=None)
def test_pieces_keep_all_rows_in_order(values, size):
    found = [v for p in pieces(iter([batch(values)]), size=size) for v in p.column(0).to_pylist()]
    assert found == [v or "" for v in values]
