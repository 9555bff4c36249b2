import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lagloom.llm.bpe import codec, encode_part, join_parts, map_tokens, parts_of
from lagloom.llm.queries import TOKEN_DIGEST, TOKENIZER, token_digest
from tests.llm.fixtures import edge_rows, frame

LIBRARY = Tokenizer.from_file(TOKENIZER)


def want(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_every_character_below_u0600_in_place():
    code = codec(TOKENIZER)
    for c in map(chr, range(0x600)):
        text = f"{c}a{c}'s {c}{c}'{c}1 A{c}b"
        assert code.encode(text).tolist() == want(text), hex(ord(c))


@given(st.text(max_size=200))
@settings(max_examples=200, deadline=None)
def test_any_text_as_the_library_does(text):
    ids = codec(TOKENIZER).encode(text).tolist()
    assert ids == want(text)
    assert codec(TOKENIZER).decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("alphabet", [["a", "aa", "b"], ["the", "tion", "ing", "x", "q"], ["!", "=", "-", "!!"], ["日", "本", "é"], ["1"]])
def test_long_unsplit_texts_by_tree_concatenation(alphabet):
    pick, code = random.Random(6), codec(TOKENIZER)
    for _ in range(40):
        text = "".join(pick.choice(alphabet) for _ in range(pick.randint(1, 900)))
        assert code.encode(text).tolist() == want(text)
        parts = list(parts_of(code.split(f"go {text} on"), 16))
        ids = [encode_part(code, kind, content) for kind, content in parts]
        assert join_parts(code, [kind for kind, _ in parts], ids).tolist() == want(f"go {text} on")


def test_special_tokens_in_texts():
    for text in ("<|endoftext|>x <|ENDOFTEXT|> a<|startoftext|>b", "<|endoftext|>", "a<|b"):
        assert codec(TOKENIZER).encode(text).tolist() == want(text)


def test_frames_with_edge_rows_and_parts(spark):
    docs = frame(spark, edge_rows()).selectExpr("*", "1 as n_tokens_before")
    for chars in (1 << 15, 600):
        found = map_tokens(docs, TOKENIZER, ["doc_id", "lang"], token_digest, TOKEN_DIGEST, piece_chars=chars).collect()
        texts = {i: t for i, t, *_ in edge_rows()}
        assert len(found) == len(edge_rows())
        for row in found:
            ids = want(texts[row.doc_id])
            decoded = LIBRARY.decode(ids, skip_special_tokens=False)
            assert row.n_tokens == len(ids)
            assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert map_tokens(docs.limit(0), TOKENIZER, ["doc_id"], token_digest, TOKEN_DIGEST).count() == 0


def test_files_with_other_decoders_are_refused():
    with pytest.raises(ValueError):
        codec(public_tokenizers.path("byte_bpe_50k.json"))
