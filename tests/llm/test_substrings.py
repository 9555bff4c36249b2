import hashlib
import random
import re

import pytest

from lagloom.llm.queries import ORACLES, op6_substring_dedup
from lagloom.llm.substrings import kept_digest, pack, remove_repeats, unpack
from tests.llm.fixtures import edge_rows, frame

import numpy as np


def brute(rows, size):
    """(n_words, n_removed, kept) per row, rows in (doc_id, text) order."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    seen, result = set(), []
    for doc_id, text, *_ in ordered:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            if window in seen:
                gone.update(range(i, i + size))
            seen.add(window)
        result.append((doc_id, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return result


def corpus(seed):
    pick = random.Random(seed)
    passages = [[f"p{k}{i}" for i in range(pick.randint(4, 30))] for k in range(5)]
    texts = []
    for _ in range(60):
        words = []
        for _ in range(pick.randint(0, 6)):
            words += pick.choice(passages) if pick.random() < 0.5 else [pick.choice("abc") for _ in range(pick.randint(1, 12))]
        texts.append(pick.choice([" ", "\n", " \t "]).join(words))
    return [(i * 3, t, None, None, None) for i, t in enumerate(texts)]


@pytest.mark.parametrize("block_bytes", [16 << 20, 300])
def test_kept_words_are_those_of_brute_force(spark, block_bytes):
    for seed in (1, 2):
        rows = corpus(seed) + edge_rows()
        found = remove_repeats(frame(spark, rows), size=5, block_bytes=block_bytes).collect()
        want = brute(rows, 5)
        key = lambda r: tuple((x is not None, x) for x in r)
        assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found), key=key) == sorted(want, key=key)
        for row in found:
            assert sum(i.end - i.start for i in row.intervals) == row.n_removed
            assert all(a.end < b.start for a, b in zip(row.intervals, row.intervals[1:]))


def test_no_documents(spark):
    assert remove_repeats(frame(spark, [])).count() == 0


def test_messages_round_trip():
    values = np.unique(np.random.default_rng(1).integers(1 << 62, (1 << 62) + (1 << 61), 3_000, dtype=np.uint64))
    assert (unpack(pack(values, 1 << 14, 1 << 14), 1 << 14, 1 << 14) == values).all()


def test_digest_is_of_the_kept_words():
    flags = np.array([False, True, False])
    assert kept_digest("a  ü\tc", flags) == (3, 1, hashlib.sha256(b"a c").hexdigest())


def test_query_against_its_sql(spark, agrees):
    agrees("op6_substring_dedup", op6_substring_dedup, ORACLES)
