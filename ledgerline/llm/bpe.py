"""Byte-level BPE encoding and decoding by per-prefix dynamic programming.

For every prefix of a pre-token the last token of its encoding is unique. The automaton lists the vocabulary
entries that end at a position; an entry is the last token of the prefix when it may follow the last token of
the shorter prefix, which a walk down the two merge trees decides. Following the stored tokens backwards from
the end gives the ids, in time linear in the text whatever its length.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame

from . import shared

#: Pre-token pattern of the vocabulary's byte-level pre-tokenizer (fixed value).
PRETOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Characters below this have their classes spelled out for the faster of the two regular-expression engines.
PLAIN_BELOW = 0x250

#: Pre-tokens of at most this many characters are remembered, so many of them at most per worker.
MEMO_CHARS, MEMO_ENTRIES = 40, 500_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(shifted)}


def plain_pretokens():
    """A findall for texts whose characters all lie below PLAIN_BELOW, equal to PRETOKEN on these."""

    def ranges(kind: str) -> str:
        codes = [i for i in range(PLAIN_BELOW) if unicodedata.category(chr(i))[0] == kind]
        starts = [i for i in codes if i - 1 not in codes]
        ends = [i for i in codes if i + 1 not in codes]
        return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(starts, ends, strict=True))

    letter, number, space = ranges("L"), ranges("N"), r"\t-\r \x85\xa0"
    return re.compile(
        rf" ?[{letter}]+| ?[{number}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    ).findall


class Codec:
    """Encoder and decoder over one vocabulary file (tokenizers JSON: byte-level BPE, ids in merge order)."""

    def __init__(self, spec: str):
        import ahocorasick
        import regex

        model = json.loads(spec)
        back = byte_alphabet()
        vocab: dict[str, int] = model["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in model["added_tokens"] if t["special"]}
        self.token_bytes: list[bytes] = [b""] * (1 + max([*vocab.values(), *self.specials.values()]))
        for token, i in vocab.items():
            if token not in self.specials:
                self.token_bytes[i] = bytes(back[c] for c in token)
        for token, i in self.specials.items():
            self.token_bytes[i] = token.encode()
        self.left, self.right = list(range(len(self.token_bytes))), list(range(len(self.token_bytes)))
        self.rank = [-1] * len(self.token_bytes)
        self.merged: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            whole = vocab[a + b]
            self.left[whole], self.right[whole], self.rank[whole] = vocab[a], vocab[b], rank
            self.merged[vocab[a], vocab[b]] = rank
        self.pairs: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for token, i in vocab.items():
            if token not in self.specials:
                raw = self.token_bytes[i]
                self.automaton.add_word(raw.decode("latin-1"), (len(raw), i))
        self.automaton.make_automaton()
        self.length = [len(b) for b in self.token_bytes]
        #: Entries by their bytes. Trained vocabularies encode an entry's own bytes to that entry alone.
        self.whole = {self.token_bytes[i]: i for token, i in vocab.items() if token not in self.specials}
        self.pretoken = regex.compile(PRETOKEN).findall
        self.plain_pretoken = plain_pretokens()
        self.beyond_plain = re.compile(f"[^\\x00-\\u{PLAIN_BELOW - 1:04x}]").search
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")").split if self.specials else None
        self.memo = Memo(self)

    def compatible(self, first: int, second: int) -> bool:
        """True if the encoding of both tokens' joined bytes is these two tokens.

        No merge across the seam may come before the merges that built the pieces beside it; the pieces are
        opened one by one, the later built first.
        """
        pairs, key = self.pairs, first << 20 | second
        known = pairs.get(key)
        if known is None:
            if len(pairs) > 1_000_000:
                pairs.clear()
            known = pairs[key] = self._seam_holds(first, second)
        return known

    def _seam_holds(self, a: int, b: int) -> bool:
        rank, merged = self.rank, self.merged
        bound = len(rank)  # rank of the earliest merge opened so far; a seam merge below it would have come first
        opened_left = False
        while True:
            seam = merged.get((a, b))
            if seam is not None and (seam < bound or seam == bound and opened_left is False):
                return False
            ra, rb = rank[a], rank[b]
            if ra < 0 and rb < 0:
                return True
            # Of equal ranks the left occurrence is merged first, so the right one is opened first.
            if ra > rb:
                bound, opened_left, a = ra, True, self.right[a]
            else:
                bound, opened_left, b = rb, False, self.left[b]

    def encode_piece(self, raw: bytes) -> list[int]:
        """Ids of one pre-token's bytes."""
        whole = self.whole.get(raw)
        if whole is not None:
            return [whole]
        last: list[int] = []
        append, known, compatible, done = last.append, self.pairs.get, self.compatible, -1
        for end, (size, token) in self.automaton.iter(raw.decode("latin-1")):
            if end == done:
                continue  # the prefix has its token
            if end >= size:
                before = last[end - size]
                fits = known(before << 20 | token)
                if fits is None:
                    fits = compatible(before, token)
                if not fits:
                    continue
            append(token)
            done = end
        return self._followed(last)

    def _followed(self, last: list[int]) -> list[int]:
        """Ids along the back-pointers from the end of a piece."""
        ids, end, length = [], len(last), self.length
        while end > 0:
            token = last[end - 1]
            ids.append(token)
            end -= length[token]
        ids.reverse()
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        find = self.pretoken if self.beyond_plain(text) else self.plain_pretoken
        get = self.memo.__getitem__
        if self.special_split is None or not any(s in text for s in self.specials):
            return b"".join(map(get, find(text)))
        out = []
        for part in self.special_split(text):
            if part in self.specials:
                out.append(struct.pack("<I", self.specials[part]))
            else:
                out.extend(map(get, find(part)))
        return b"".join(out)

    def decode(self, packed: bytes) -> str:
        """Text of packed ids; bytes that are not UTF-8 become U+FFFD."""
        ids = memoryview(packed).cast("I") if sys.byteorder == "little" else struct.unpack(f"<{len(packed) // 4}I", packed)
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


class Memo(dict):
    """Packed ids by pre-token; bounded, as a long tail of rare pre-tokens passes through."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        ids = self.codec.encode_piece(piece.encode())
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[piece] = packed
        return packed


def _codec(spec: str) -> Codec:
    """One codec per Python worker and vocabulary, kept between tasks."""
    kept = sys.__dict__.setdefault("_ledgerline_codecs", {})
    key = hash(spec)
    if key not in kept:
        kept.clear()
        kept[key] = Codec(spec)
    return kept[key]


def encode_decode(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text", batch_chars: int = 4_000_000) -> DataFrame:
    """Encode each whole text and decode its ids again.

    vocabulary: path of the vocabulary file, read on the driver and broadcast (a few MB, fixed). Returns id_col,
    n_tokens long, ids binary (little-endian unsigned 32-bit), decoded string. One output row per input row,
    repeated rows included; a null text counts as empty (no ids); other columns are dropped. There is no
    shuffle: rows are encoded where they are read.
    """
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches):
        codec = _codec(spec.value)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            start, sizes, packed, decoded = 0, 0, [], []
            for i in range(len(texts)):
                text = texts[i].as_py() or ""
                packed.append(codec.encode(text))
                decoded.append(codec.decode(packed[-1]))
                sizes += len(text)
                if sizes >= batch_chars or i == len(texts) - 1:
                    counts = pa.array([len(p) // 4 for p in packed], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(start, i + 1 - start), counts, pa.array(packed, pa.binary()), pa.array(decoded, pa.string())],
                        ["id", "n_tokens", "ids", "decoded"],
                    )
                    start, sizes, packed, decoded = i + 1, 0, [], []

    out = rows.mapInArrow(run, f"id {id_type}, n_tokens bigint, ids binary, decoded string")
    return out.withColumnRenamed("id", id_col)


shared.by_value(sys.modules[__name__])
