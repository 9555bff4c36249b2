import random
import re

import pyarrow as pa
import pytest

from lagloom.llm.queries import op8_secret_scan
from lagloom.llm.secret_scan import BASE_KINDS, RULES, compile_rules, find_secrets, redact, scanner
from tests.llm.fixtures import edge_rows, frame

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(RULES[kind].kind, start, end) for start, kind, end in sorted(found)]


def random_texts(count, seed=1):
    pick = random.Random(seed)
    parts = ["token", "Secret", "api_key", "apikey", "passwd", "PASSWORD", " ", "  ", ":", "=", '"', "'", "abc", "AKIA", "ABCD1234EF"]
    parts += ["0123456789abcdef", "é", "ß", "\n", "-", "x", "deadbeef" * 5, ",", "A", "akia"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 60))) for _ in range(count)]
    return [*texts, "ab" * 30_000 + 'token="abcdefgh1234"', "", 'x token = "' + "ä" * 9]


def test_spans_are_those_of_the_regexes():
    texts = random_texts(3_000)
    found = scanner(RULES).spans(pa.record_batch([pa.array(texts)], names=["text"]))
    for i, text in enumerate(texts):
        assert [span for span in found.get(i, []) if span[0] in BASE_KINDS] == brute(text)


def test_other_rules_add_spans():
    text = f"a ghp_{'A1b2' * 6} b xoxb-12345-abcdef c -----BEGIN RSA PRIVATE KEY-----"
    found = scanner(RULES).spans(pa.record_batch([pa.array([text])], names=["text"]))[0]
    assert [kind for kind, _, _ in found] == ["github", "slack", "pem"]


def test_automaton_is_minimal_for_one_word():
    automaton = compile_rules([("ab|cb", False)], anywhere=False)
    assert len(automaton.moves) // automaton.classes == 4  # start, dead, after the first letter, end


def test_unsupported_rules_are_refused():
    with pytest.raises(ValueError):
        compile_rules([("a(?=b)", False)], anywhere=False)


def test_edge_rows(spark):
    docs = frame(spark, edge_rows())
    found = find_secrets(docs).collect()
    assert sorted(r.doc_id is not None and r.doc_id for r in found) == sorted(i is not None and i for i, *_ in edge_rows())
    assert all(r.spans == [] for r in found)
    assert find_secrets(docs.limit(0)).collect() == []


def test_redaction_keeps_all_other_columns(spark):
    docs = frame(spark, [*edge_rows(), (90, 'a token="abcdefghijkl" b', "en", "s", 24), (91, f"k {'0f' * 16}", None, None, None)])
    docs = docs.selectExpr("*", "1 as kind", "2 as spans")
    found = {r.doc_id: r for r in redact(docs).collect()}
    assert found[90].text == 'a [assign]" b' and found[90].n_chars == len(found[90].text)
    assert found[91].text == "k [hex]"
    assert found[0].text is None and found[1].text == "" and (found[90].kind, found[90].spans) == (1, 2)
    assert redact(docs).schema == docs.schema


def test_query_counts_and_joins_base_spans(spark, tmp_path):
    texts = random_texts(300, seed=4)
    frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]).write.parquet(f"{tmp_path}/documents.parquet")
    import hashlib

    for row in op8_secret_scan(spark, str(tmp_path)).collect():
        want = brute(texts[row.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(k == kind for k, _, _ in want) for kind in BASE_KINDS]
        assert set(joined.split(",")) <= set(row.spans.split(",")) | {""}
