"""BPE encoding and decoding with forced-boundary splitting.

No merge joins two bytes that stand next to each other in no token of the vocabulary, so a cut between
them is certain whatever else the text holds. A text is cut at its special tokens, at white space (which
the tokenizer drops), and, inside the words its pre-tokenizer makes of the rest, at all such byte pairs.
The fragments are encoded independently by the tokenizer's merge model and their ids concatenated; only
the last fragment of a word carries the end-of-word mark. Results are kept per distinct piece of text
between white space, in two generations of bounded size.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from operator import add

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer, models

from tidelake.llm.tables import map_arrow

KEPT_PIECES = 150_000
KEPT_WORDS = 200_000
LONGEST_KEPT = 64
BATCH_CHARS = 1 << 20

#: Texts with these characters are left to the library's normaliser: below U+0250 every text is in
#: composed form and str.lower() is the library's; of the separators, str.split() alone takes 0x1C-0x1F.
UNUSUAL = re.compile("[\x1c-\x1f\u0250-\U0010ffff]")

#: Byte-level words write printable Latin-1 bytes as themselves and the others from U+0100 on.
_plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_others = [b for b in range(256) if b not in _plain]
BYTE_CHARS = {b: chr(0x100 + k) for k, b in enumerate(_others)}


def to_bytes(word: str) -> str:
    """``word`` with a byte-level character for each byte of its UTF-8."""
    return word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(BYTE_CHARS)


class TwoGenerations(dict):
    """A cache of at most 2 x ``most`` entries that forgets what was not used for ``most`` new ones."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        if len(key) <= LONGEST_KEPT:
            self[key] = value
        return value


class Codec:
    """A word-end BPE tokenizer with byte-level words, as a file of the tokenizers library describes it."""

    def __init__(self, description: str):
        spec = json.loads(description)
        self.tokenizer = Tokenizer.from_str(description)
        self.spec, self.suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        vocab = self.spec["vocab"]
        self.token_of = {i: token for token, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_of |= {i: token for token, i in self.special.items()}
        bodies = (token.removesuffix(self.suffix) for token in vocab)
        self.joined = {body[i : i + 2] for body in bodies for i in range(len(body) - 1)}
        self.ending, self._inner = self.tokenizer.model, None
        marks = sorted(self.special, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, marks)) + ")") if marks else None
        self.split_words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        self.words = TwoGenerations(self.encode_word, KEPT_WORDS)
        self.pieces = TwoGenerations(self.encode_piece, KEPT_PIECES)

    @property
    def inner(self):
        """The same merges for fragments that do not end a word."""
        if self._inner is None:
            merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in self.spec["merges"]]
            self._inner = models.BPE(vocab=self.spec["vocab"], merges=merges)
        return self._inner

    def fragments(self, word: str) -> list[str]:
        """``word``, in byte-level characters, cut at every pair that no token holds."""
        if self.joined.issuperset(map(add, word, word[1:])):
            return [word]
        cuts = [i + 1 for i in range(len(word) - 1) if word[i : i + 2] not in self.joined]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True)]

    def encode_word(self, word: str) -> tuple[bytes, bytes]:
        """Ids of a word in byte-level characters, and their decoded form."""
        *inner, last = self.fragments(word)
        ids = [t.id for fragment in inner for t in self.inner.tokenize(fragment)]
        ids += [t.id for t in self.ending.tokenize(last)]
        return array("i", ids).tobytes(), self.decode(ids).encode()

    def encode_piece(self, piece: str) -> tuple[bytes, bytes]:
        """The same of a normalised text without white space."""
        if piece.isascii() and piece.isalpha():
            return self.words[piece]
        if UNUSUAL.search(piece):
            words = [word for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(piece)]
        else:
            words = [to_bytes(word) for word in self.split_words(piece)]
        parts = [self.words[word] for word in words]
        return b"".join([x for x, _ in parts]), b" ".join([y for _, y in parts])

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by spaces, special ones included: the file names no decoder of its own."""
        return " ".join(self.token_of[i] for i in ids)

    def cut(self, text: str) -> list[str]:
        """The normalised pieces between white space."""
        if UNUSUAL.search(text):
            return [x for x in self.tokenizer.normalizer.normalize_str(text).split(" ") if x]
        return text.lower().split()

    def encode_text(self, text: str) -> tuple[bytes, bytes]:
        """Ids (32 bits each) and decoded text in UTF-8."""
        found = []
        for k, part in enumerate(self.marks.split(text) if self.marks and "<" in text else [text]):
            if k % 2:
                found.append((array("i", [self.special[part]]).tobytes(), part.encode()))
            else:
                found += map(self.pieces.__getitem__, self.cut(part))
        return b"".join([x for x, _ in found]), b" ".join([y for _, y in found if y])


def encoder(description: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(description)

        def packed(part: pa.RecordBatch, ids: list[bytes], decoded: list[bytes]) -> pa.RecordBatch:
            ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(ids), dtype=np.int32))
            lists = pa.ListArray.from_arrays(pa.array(ends), values)
            columns = [*part.columns, lists, pa.array(decoded, pa.binary()).cast(pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=[*names, "ids", "decoded"])

        for batch in batches:
            ids, decoded, begin, held = [], [], 0, 0
            for row, text in enumerate(batch.column("text")):
                text = text.as_py() or ""
                x, y = codec.encode_text(text)
                ids.append(x)
                decoded.append(y)
                held += len(text)
                if held > BATCH_CHARS:
                    yield packed(batch.slice(begin, row + 1 - begin), ids, decoded)
                    ids, decoded, begin, held = [], [], row + 1, 0
            if ids:
                yield packed(batch.slice(begin), ids, decoded)

    return run


def encode_decode(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """``docs`` with ``ids`` (array of int) and ``decoded`` (text of those ids).

    Equal to the tokenizers library's encode without added special tokens and decode with special tokens
    kept. A text that is NULL counts as empty and has no ids. Other columns pass through; columns called
    ids or decoded give way. The file is read by the driver and its content sent along.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        description = file.read()
    docs = docs.drop("ids", "decoded")
    more = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    return map_arrow(docs, encoder(description, docs.columns), T.StructType([*docs.schema.fields, *more]))
