"""BPE encoding and decoding of whole texts with a public tokenizer file, long unsplit text by tree concatenation.

The tokenizer's normaliser and pre-tokenizer cut a text into words (pieces that merges never cross). A word longer
than a leaf is halved until its parts fit, the parts are encoded independently, and neighbours are joined by
encoding a growing window around the join anew until its first and last token are those of the two sides. Every
adjacent pair of tokens then comes from a proper encoding, which for merges by rank makes the whole one proper.
Texts longer than ``PIECE_CHARS`` are dealt over the cluster in parts; their tokens meet again per document.

Defined results: a null text is an empty one (no tokens); repeated rows give repeated results; a text may hold the
strings of special tokens, which become their ids as the library does it.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import BPE

from lagloom.llm.batches import pieces
from lagloom.llm.staging import arrow_schema

PIECE_CHARS = 1 << 15
LEAF_CHARS = 64
#: Words whose ids a Python worker keeps.
KEPT_WORDS = 250_000

_PLAIN_LIMIT = 0x180
_WHITE = {*range(9, 14), 32, 0x85, 0xA0}


def _chars(test: Callable[[int], bool]) -> str:
    return "".join(re.escape(chr(c)) for c in range(_PLAIN_LIMIT) if c not in _WHITE and test(c))


_LETTERS = _chars(lambda c: unicodedata.category(chr(c))[0] == "L")
_NUMBERS = _chars(lambda c: unicodedata.category(chr(c))[0] == "N")
_SPACES = "".join(re.escape(chr(c)) for c in sorted(_WHITE))
#: The pre-tokenizer's pattern for characters below U+0180, which NFC leaves alone and whose lower case stays below it.
_PLAIN_WORDS = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+")
_NOT_PLAIN = re.compile(f"[^\0-{chr(_PLAIN_LIMIT - 1)}]")
#: The pattern for which the fast way above was written.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Marks a special token among the words of a part; words hold no white space.
SPECIAL = "\t"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Codec:
    """A tokenizer file as words and merges. A Python worker holds one; merges for parts of words are read on demand."""

    def __init__(self, path: str) -> None:
        self.path = path
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if self.tokenizer.decoder is not None:
            raise ValueError("only tokenizer files without a decoder are supported")
        self.whole = self.tokenizer.model
        self.suffix = self.whole.end_of_word_suffix or ""
        self.special = {token.content: i for i, token in self.tokenizer.get_added_tokens_decoder().items()}
        self.specials = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.strings = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.decimals = [b"%d" % i for i in range(size)]
        self.bytes_to_chars = byte_characters()
        with open(path, encoding="utf-8") as file:
            self.plain = json.dumps(_PATTERN) in file.read() and self.suffix == "</w>"
        self.words = _Words(self)

    @cached_property
    def inner(self) -> BPE:
        """The model for parts that don't end a word."""
        with open(self.path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        return BPE(vocab=model["vocab"], merges=merges)

    def split(self, text: str) -> list[str]:
        """The words of a text in order, special tokens with SPECIAL in front."""
        if not self.special or "<" not in text:
            return self._split(text)
        found, at = [], 0
        for match in self.specials.finditer(text):
            found += self._split(text[at : match.start()])
            found.append(SPECIAL + match[0])
            at = match.end()
        return found + self._split(text[at:])

    def _split(self, text: str) -> list[str]:
        if self.plain and not _NOT_PLAIN.search(text):
            return _PLAIN_WORDS.findall(text.lower())
        text = self.tokenizer.normalizer.normalize_str(text)
        return [self._unbyte(word) for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def _unbyte(self, word: str) -> str:
        back = {c: b for b, c in enumerate(self.bytes_to_chars)}
        return bytes(back[c] for c in word).decode("utf-8", "surrogateescape")

    def encode_word(self, word: str) -> list[int]:
        if word.startswith(SPECIAL):
            return [self.special[word[1:]]]
        symbols = self.symbols(word)
        if len(symbols) <= LEAF_CHARS:
            return self.encode_part(symbols, True)
        leaves = halves(symbols, LEAF_CHARS)
        return self.join_all([self.encode_part(leaf, leaf is leaves[-1]) for leaf in leaves])

    def symbols(self, word: str) -> str:
        if word.isascii() and word.isprintable():  # such bytes stand for themselves
            return word
        return "".join(self.bytes_to_chars[b] for b in word.encode("utf-8", "surrogateescape"))

    def encode_part(self, symbols: str, ends_word: bool) -> list[int]:
        return [token.id for token in (self.whole if ends_word else self.inner).tokenize(symbols)]

    def join_all(self, parts: list[list[int]]) -> list[int]:
        """The encodings of neighbouring parts as one, joined in pairs level by level."""
        while len(parts) > 1:
            parts = [self.join(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0] if parts else []

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two parts together: the window around the join grows until both sides agree."""
        if not left or not right:
            return left or right
        a, b = 1, 1
        while True:
            a, b = min(a, len(left)), min(b, len(right))
            symbols = "".join(map(self.strings.__getitem__, left[len(left) - a :] + right[:b]))
            ends_word = bool(self.suffix) and symbols.endswith(self.suffix)
            window = self.encode_part(symbols.removesuffix(self.suffix) if ends_word else symbols, ends_word or not self.suffix)
            agrees_left = a == len(left) or window[0] == left[-a]
            agrees_right = b == len(right) or window[-1] == right[b - 1]
            if agrees_left and agrees_right:
                return left[: len(left) - a] + window + right[b:]
            a, b = (a if agrees_left else 2 * a), (b if agrees_right else 2 * b)

    def ids(self, words: list[str]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.words.__getitem__, words)), dtype="<u4")

    def encode(self, text: str) -> np.ndarray:
        return self.ids(self.split(text))

    def decode(self, ids: list[int]) -> str:
        """As the library without a decoder: the tokens' strings with blanks between."""
        return " ".join(map(self.strings.__getitem__, ids))


@cache
def _packer(count: int) -> struct.Struct:
    return struct.Struct(f"<{count}I")


class _Words(dict):
    """Ids of words as little-endian bytes; forgets all when it holds KEPT_WORDS."""

    def __init__(self, codec: Codec) -> None:
        self.codec = codec

    def __missing__(self, word: str) -> bytes:
        ids = _packer(len(tokens := self.codec.encode_word(word))).pack(*tokens)
        if len(word) <= LEAF_CHARS:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = ids
        return ids


def halves(symbols: str, most: int) -> list[str]:
    """The text halved until no part is longer than ``most``."""
    if len(symbols) <= most:
        return [symbols]
    middle = len(symbols) // 2
    return halves(symbols[:middle], most) + halves(symbols[middle:], most)


@cache
def codec(path: str) -> Codec:
    """Loaded once in a Python worker."""
    return Codec(path)


def parts_of(words: list[str], most: int) -> Iterator[tuple[str, str]]:
    """(kind, content) of the parts of a long text: several words, or a leaf of one long word and its last leaf."""
    group, size = [], 0
    for word in words:
        if len(word) > most:
            if group:
                yield "words", "\n".join(group)
                group, size = [], 0
            leaves = halves(word, most)
            yield from (("leaf", leaf) for leaf in leaves[:-1])
            yield "last", leaves[-1]
            continue
        if group and size + len(word) > most:
            yield "words", "\n".join(group)
            group, size = [], 0
        group.append(word)
        size += len(word) + 1
    if group:
        yield "words", "\n".join(group)


def encode_part(code: Codec, kind: str, content: str) -> np.ndarray:
    if kind == "words":
        return code.ids(content.split("\n"))
    leaves = halves(code.symbols(content), LEAF_CHARS)
    ids = code.join_all([code.encode_part(leaf, kind == "last" and leaf is leaves[-1]) for leaf in leaves])
    return np.array(ids, dtype="<u4")


def join_parts(code: Codec, kinds: list[str], ids: list[np.ndarray]) -> np.ndarray:
    """The tokens of a document from those of its parts in order."""
    found, leaves = [], []
    for kind, part in zip(kinds, ids):
        if kind == "words":
            found.append(part)
            continue
        leaves.append(part.tolist())
        if kind == "last":
            found.append(np.array(code.join_all(leaves), dtype="<u4"))
            leaves = []
    return np.concatenate(found) if found else np.zeros(0, dtype="<u4")


def map_tokens(
    docs: DataFrame, path: str, columns: list[str], outcome: Callable, result_schema: str, piece_chars: int = PIECE_CHARS
) -> DataFrame:
    """``columns`` of every row and ``outcome(codec, ids)`` of its text's tokens, a tuple for ``result_schema``.

    Short texts are encoded where they are read. The parts of long ones are dealt out by a hash of the row and the
    part, encoded, and brought together again by row.
    """
    kept = docs.select(*columns).schema
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in kept] + [result_schema])
    fields = list(arrow_schema(result_schema))

    def rows(batch: pa.RecordBatch, results: list[tuple]) -> pa.RecordBatch:
        values = [pa.array(list(column), field.type) for column, field in zip(zip(*results), fields)]
        own = [batch.column(batch.schema.get_field_index(c)) for c in columns]
        return pa.record_batch([*own, *values], names=[*columns, *(field.name for field in fields)])

    def short_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for piece in pieces(batches):
            texts = piece.column(piece.schema.get_field_index("text")).to_pylist()
            yield rows(piece, [outcome(code, code.encode(text)) for text in texts])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for piece in pieces(batches):
            for i in range(piece.num_rows):
                text = piece.column(piece.schema.get_field_index("text"))[i].as_py()
                found = list(parts_of(code.split(text), piece_chars)) or [("words", "")]
                one = piece.slice(i, 1).drop_columns(["text"])
                repeated = one.take(pa.array([0] * len(found)))
                yield pa.record_batch(
                    [*repeated.columns, pa.array(range(len(found)), pa.int32()), *(pa.array(list(c), pa.string()) for c in zip(*found))],
                    names=[*one.schema.names, "_part", "_kind", "_content"],
                )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for piece in pieces(batches, "_content"):
            kinds = piece.column(piece.schema.get_field_index("_kind")).to_pylist()
            contents = piece.column(piece.schema.get_field_index("_content")).to_pylist()
            ids = [encode_part(code, k, c).tobytes() for k, c in zip(kinds, contents)]
            yield piece.drop_columns(["_content"]).append_column("_ids", pa.array(ids, pa.binary()))

    def gather(group: pa.Table) -> pa.Table:
        code = codec(path)
        group = group.sort_by("_part").combine_chunks()
        ids = [np.frombuffer(b, dtype="<u4") for b in group.column("_ids").to_pylist()]
        whole = join_parts(code, group.column("_kind").to_pylist(), ids)
        return pa.Table.from_batches([rows(group.slice(0, 1).to_batches()[0], [outcome(code, whole)])])

    wanted = list(dict.fromkeys([*columns, "text"]))
    is_long = F.coalesce(F.length("text"), F.lit(0)) > piece_chars
    short = docs.where(~is_long).select(*wanted).mapInArrow(short_texts, schema)
    own = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept if f.name != "text")
    row = f"_row long{', ' + own if own else ''}, _part int, _kind string, "
    carried = [c for c in wanted if c not in columns]
    if carried != ["text"]:
        raise ValueError("text can't be among the kept columns of long texts")
    parts = (
        docs.where(is_long)
        .select(F.monotonically_increasing_id().alias("_row"), *wanted)
        .mapInArrow(cut, row + "_content string")
        .repartition(F.xxhash64("_row", "_part"))
        .mapInArrow(encode, row + "_ids binary")
    )
    return short.unionByName(parts.groupBy("_row").applyInArrow(gather, schema))
