import zlib

import numpy as np
import pyarrow.fs as pafs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lagloom.llm import dac
from lagloom.llm.dac import MANIFEST, Shard, decode_levels, encode_levels, open_shard, pack_shard, read_tokens, write_tokens
from lagloom.llm.queries import TOKENIZER
from tests.llm.fixtures import edge_rows, frame


@given(st.lists(st.integers(0, 2**32 - 1), max_size=1500))
@settings(max_examples=60, deadline=None)
def test_levels_round_trip(ids):
    assert decode_levels(encode_levels(np.array(ids, dtype=np.uint32))).tolist() == ids


def test_any_token_by_itself(tmp_path):
    random = np.random.default_rng(1)
    ids = (random.integers(0, 2**32, 5_000) >> random.integers(0, 32, 5_000)).astype(np.uint32)
    path = f"{tmp_path}/one.dac"
    with open(path, "wb") as file:
        file.write(pack_shard([None, 4, 9], np.array([0, 4_000, 1_000]), ids))
    shard = Shard(pafs.LocalFileSystem().open_input_file(path))
    assert [shard.token(i) for i in range(5_000)] == ids.tolist() == shard.all().tolist()
    assert shard.doc_ids == [None, 4, 9] and shard.document(2) == ids[4_000:].tolist() and shard.document(0) == []
    for wrong in (-1, 5_000):
        try:
            shard.token(wrong)
        except IndexError:
            continue
        raise AssertionError(wrong)


def test_files_hold_the_library_ids_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dac, "SHARD_TOKENS", 10_000)
    folder = f"file://{tmp_path}/tokens"
    docs = frame(spark, [(i, t, None, None, None) for i, t, *_ in reversed(edge_rows())]).selectExpr("*", "1 as start")
    library = Tokenizer.from_file(TOKENIZER)
    manifest = write_tokens(docs.repartition(5), folder, TOKENIZER)
    assert manifest.count() > 1
    found = sorted(read_tokens(spark, folder).collect(), key=lambda r: r.start)
    ordered = sorted(edge_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for row, (doc_id, text, *_) in zip(found, ordered, strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        assert (row.doc_id, row.start, row.n_tokens) == (doc_id, start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)
    first = open_shard(manifest.orderBy("part", "shard").first().path)
    assert first.token(0) == library.encode("one two three", add_special_tokens=False).ids[0]


def test_no_documents(spark, tmp_path):
    folder = f"file://{tmp_path}/none"
    assert write_tokens(frame(spark, []), folder, TOKENIZER).count() == 0
    assert read_tokens(spark, folder).count() == 0
    assert MANIFEST
