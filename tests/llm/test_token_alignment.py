import hashlib
from bisect import bisect_left
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lagloom.llm import token_alignment
from lagloom.llm.queries import op11_token_alignment
from lagloom.llm.token_alignment import Aligner, align_texts, align_tokenizers, sections
from tests.llm.fixtures import edge_rows, frame, prose, rows

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A, B = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
A.encode_special_tokens = True
OWN = Aligner(*PATHS)
PARTS = ["wor", "ld", " ", "  ", "\n", "the", " The", "é", "日本", "😀", "▁", "<s>", "<|endoftext|>", "<0x41>", "'ll", "1", "99", ".", "\x00", "\x1c", " ", "\t", "ǅ"]


def spans(text):
    """Whole texts through both libraries, byte ranges of all tokens; None where the bytes differ."""
    if not text:
        return None
    whole = f" {text}".encode()
    found = []
    for ids, table in ((A.encode(f" {text}", add_special_tokens=False).ids, OWN.a_bytes), (B.encode(text), OWN.b_bytes)):
        if b"".join(table[i] for i in ids) != whole:
            return None
        end, own = 0, []
        for i in ids:
            own.append((i, end, end + len(table[i])))
            end += len(table[i])
        found.append(own)
    return found


def groups_of(text):
    found = spans(text)
    if not found:
        return []
    cuts = sorted({e for _, _, e in found[0]} & {e for _, _, e in found[1]})

    def inside(own, start, cut):
        first = bisect_left(own, start, key=lambda token: token[1])
        return [i for i, _, end in own[first : first + cut - start] if end <= cut]

    return [[inside(own, start, cut) for own in found] for start, cut in zip([0, *cuts], cuts)]


def brute(texts):
    links = [Counter((a, b) for left, right in groups_of(t) for a in left for b in right) for t in texts]
    count = Counter(pair for own in links for pair in own)
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    out = []
    for text, own in zip(texts, links):
        groups, tokens = groups_of(text), spans(text) or [[], []]
        best = sum(n for p, n in own.items() if count[p] == top[p[0]])
        joined = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        digest = hashlib.sha256(joined.encode()).hexdigest() if groups else ""
        out.append((len(tokens[0]), len(tokens[1]), len(groups), sum(own.values()), best, sum(n * count[p] for p, n in own.items()), digest))
    return out


def compared(frame_of_docs):
    found = [tuple(r)[1:] for r in align_tokenizers(frame_of_docs, *PATHS).collect()]
    assert sorted(found) == sorted(brute([r.text for r in frame_of_docs.collect()]))
    return found


@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=3)), max_size=14).map("".join))
@settings(max_examples=400, deadline=None)
def test_batches_agree_with_whole_texts(text):
    text = text.encode("utf-8", "ignore").decode()
    # between texts that leave nothing and something
    n_a, n_b, n_groups, n_links, digest, same, same_links, pairs, pair_links = align_texts(OWN, ["one", "", text, "two"])[2]
    [(want_a, want_b, want_groups, want_links, _, _, want_digest)] = brute([text])
    assert (n_a, n_b, n_groups, n_links, digest) == (want_a, want_b, want_groups, want_links, want_digest)
    own = Counter((a, b) for left, right in groups_of(text) for a in left for b in right)
    found = {(a, OWN.same[a]): n for a, n in zip(same, same_links)} | {(p >> 16, p & 65535): n for p, n in zip(pairs, pair_links)}
    assert found == own
    assert not any(OWN.same[p >> 16] == p & 65535 for p in pairs)


@given(st.lists(st.sampled_from([*PARTS, " a", "b c", ". D", "! e"]), max_size=60).map("".join))
@settings(max_examples=150, deadline=None)
def test_sections_are_encoded_apart(text):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(token_alignment, "SECTION_CHARS", 2)
        patch.setattr(token_alignment, "EXPANDED_LINKS", 3)
        assert "".join(sections(f" {text}")) == f" {text}"
        [found] = align_texts(OWN, [text])
    [(n_a, n_b, n_groups, n_links, _, _, digest)] = brute([text])
    assert found[:5] == (n_a, n_b, n_groups, n_links, digest)


def test_ranks_agree_with_the_library():
    """Every code point beside letters, digits, spaces and itself: the word pattern has the same classes in both."""
    points = [chr(i) for i in [*range(0x3400), *range(0x3400, 0x110000, 251)] if not 0xD800 <= i < 0xE000]
    texts = [f" {c} a{c}a 1{c}1 .{c}. {c}  {c}\n{c}" for c in points]
    assert OWN.fast_a is not None
    wanted = [e.ids for e in A.encode_batch_fast(texts, add_special_tokens=False)]
    assert list(map(OWN.fast_a.encode_ordinary, texts)) == wanted
    long = [" " + "x" * 50_000, " " * 30_000 + "a", "a b c", " ab" * 3_000 + "é" * 2_000]
    assert list(OWN.a_ids(long)) == [A.encode(t, add_special_tokens=False).ids for t in long]


def test_vocabulary_bytes():
    assert len(set(OWN.a_bytes)) == len(OWN.a_bytes) and all(bytes([b]) in OWN.a_bytes for b in range(256))
    assert OWN.same[A.token_to_id("Ġthe")] == B.piece_to_id("▁the")
    assert OWN.b_bytes[OWN.same[OWN.a_bytes.index(b"A")]] == b"A" and not B.is_byte(OWN.same[OWN.a_bytes.index(b"A")])


@pytest.mark.parametrize("most", [1 << 16, 5, 0])
def test_corpus_counts(spark, monkeypatch, most):
    monkeypatch.setattr(token_alignment, "FREQUENT_PAIRS", most)
    texts = [prose(1), prose(2), prose(1), "a▁b", "".join(PARTS), "x" * 3000 + "ß" * 500, "<|endoftext|> <s> unword unworld"]
    table = frame(spark, edge_rows() + rows(texts, 100)).selectExpr("*", "1 as row", "2 as n_a", "3 as pairs").repartition(3)
    found = compared(table)
    assert (0, 0, 0, 0, 0, 0, "") in found


def test_empty_tables(spark):
    assert align_tokenizers(frame(spark, []), *PATHS).count() == 0
    assert compared(frame(spark, rows([None, ""]))) == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_query_agrees_with_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = {d.doc_id: row for d, row in zip(docs, brute([d.text for d in docs]))}
    got = {r[0]: tuple(r)[1:] for r in op11_token_alignment(spark, "/root/testdata/sf0.001").collect()}
    assert got == want
