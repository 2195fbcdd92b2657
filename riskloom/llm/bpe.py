"""Byte-level BPE by backtracking, and decoding by an offset table.

The encoder never applies merges one by one. An Aho-Corasick automaton finds the longest token that
starts at each byte of a piece; tokens are then laid down from the left, and a token may follow
another only if the two are compatible, that is if merging their joint bytes would give just these
two. A token that doesn't fit is replaced by its longest shorter prefix; if none fits, the previous
token is taken back. Positions from which no continuation was found are marked, so each is tried
once and the work stays linear in the piece.

Pieces come from the pattern of the tokenizer file and are encoded once per task as long as they
stay in a bounded cache; the cache has no influence on results.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.llm import words
from riskloom.llm.common import table, text_of

#: The splitting pattern of the byte-level pre-tokenizer. White space is Unicode's.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Entries of a task's piece cache and of its pair table; both start anew when full.
PIECES, PAIRS = 250_000, 500_000
#: Longer pieces are not cached (bytes); tokens decoded together.
CACHED_BYTES, DECODED = 64, 1 << 20


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies: printable Latin-1
    bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters = {chr(b): b for b in plain}
    letters.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))})
    return letters


class Vocabulary:
    """Tables of a byte-level BPE tokenizer file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, letters = spec["model"], byte_letters()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        self.id_of = {as_bytes(t): i for t, i in model["vocab"].items() if all(c in letters for c in t)}
        self.special = {a["content"]: a["id"] for a in spec.get("added_tokens", [])}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {i: -1 for b, i in self.id_of.items() if len(b) == 1}
        self.joined: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = map(as_bytes, merge.split(" ") if isinstance(merge, str) else merge)
            pair = (self.id_of[left], self.id_of[right])
            self.joined[pair] = self.id_of[left + right]
            self.parts.setdefault(self.id_of[left + right], pair)
            self.rank.setdefault(self.id_of[left + right], rank)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        return cls(Path(path).read_text(encoding="utf-8"))


class Encoder:
    """Encodes texts as the tokenizer file says, added tokens included, without special framing."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick
        import regex

        self.v = vocabulary
        self.size = {i: len(b) for b, i in vocabulary.id_of.items() if i in vocabulary.rank}
        self.automaton = ahocorasick.Automaton()
        for b, i in vocabulary.id_of.items():
            if i in vocabulary.rank:
                self.automaton.add_word(b.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.shorter = self._shorter()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.split = regex.compile(PATTERN).findall
        self.added = re.compile("(" + "|".join(map(re.escape, vocabulary.special)) + ")") if vocabulary.special else None
        self.pieces = _Pieces(self)

    def _shorter(self) -> dict[int, int]:
        """The longest other token that a token begins with."""
        out = {}
        for b, i in self.v.id_of.items():
            if i in self.v.rank:
                for n in range(len(b) - 1, 0, -1):
                    other = self.v.id_of.get(b[:n])
                    if other in self.v.rank:
                        out[i] = other
                        break
        return out

    def compatible(self, left: int, right: int) -> bool:
        """Whether the bytes of the two tokens merge into just these two.

        Seen backwards in time, each token falls apart by undoing its last merge. As long as both
        ends at the border exist together, a merge across the border must not come before the
        merges that consume either end; of equal merges the left one comes first.
        """
        known = self.pairs.get((left, right))
        if known is None:
            known = self._compatible(left, right)
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            self.pairs[left, right] = known
        return known

    def _compatible(self, left: int, right: int) -> bool:
        rank, parts, joined = self.v.rank, self.v.parts, self.v.joined
        left_until = right_until = len(rank)
        while True:
            across = joined.get((left, right))
            if across is not None and rank[across] < left_until and rank[across] <= right_until:
                return False
            if rank[left] < 0 and rank[right] < 0:
                return True
            if rank[left] > rank[right]:
                left_until, left = rank[left], parts[left][1]
            else:
                right_until, right = rank[right], parts[right][0]

    def encode_bytes(self, piece: bytes) -> list[int]:
        """Tokens of one piece."""
        whole = self.v.id_of.get(piece)
        if whole in self.v.rank:
            return [whole]
        longest: list[int] = [-1] * len(piece)
        size, shorter = self.size, self.shorter
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - size[token]] = token
        dead = bytearray(len(piece) + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < len(piece):
            while token is not None and (dead[at + size[token]] or out and not self.compatible(out[-1], token)):
                token = shorter.get(token)
            if token is not None:
                out.append(token)
                at += size[token]
                token = longest[at] if at < len(piece) else None
            else:
                dead[at] = 1
                last = out.pop()
                at -= size[last]
                token = shorter.get(last)
        return out

    def encode(self, text: str) -> np.ndarray:
        """Token ids of a whole text."""
        if self.added is None or not any(s in text for s in self.v.special):
            return self._plain(text)
        parts = self.added.split(text)
        special = [np.array([self.v.special[p]], np.int32) if k % 2 else self._plain(p) for k, p in enumerate(parts)]
        return np.concatenate(special)

    def _plain(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.split(text))), np.int32)


class _Pieces(dict):
    """Encoded pieces, filled on demand."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode("utf-8")
        ids = np.array(self.encoder.encode_bytes(raw), np.int32).tobytes()
        if len(raw) <= CACHED_BYTES:
            if len(self) >= PIECES:
                self.clear()
            self[piece] = ids
        return ids


class Decoder:
    """Token ids to text by one table of bytes and one of offsets. Ids without a token are skipped."""

    def __init__(self, vocabulary: Vocabulary):
        names = {i: b for b, i in vocabulary.id_of.items()}
        names.update({i: s.encode("utf-8") for s, i in vocabulary.special.items()})
        tokens = [names.get(i, b"") for i in range(max(names) + 1)]
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)

    def lengths(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of each token."""
        known = (ids >= 0) & (ids < len(self.offsets) - 1)
        safe = np.where(known, ids, 0)
        return np.where(known, self.offsets[safe + 1] - self.offsets[safe], 0)

    def join(self, ids: np.ndarray) -> bytes:
        """Bytes of all tokens."""
        out = []
        for k in range(0, len(ids), DECODED):
            part = ids[k : k + DECODED].astype(np.int64)
            size = self.lengths(part)
            ends = np.cumsum(size)
            first = np.where(size > 0, self.offsets[np.where(size > 0, part, 0)], 0)
            at = np.repeat(first - (ends - size), size) + np.arange(ends[-1])
            out.append(self.bytes[at].tobytes())
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        """Text; bytes that are no UTF-8 become replacement characters."""
        return self.join(ids).decode("utf-8", "replace")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def shared_file(spark: SparkSession, path: str | None):
    """The tokenizer file as a broadcast text (a fixed size of a few MB), read on the driver."""
    return spark.sparkContext.broadcast(Path(path or default_path()).read_text(encoding="utf-8"))


def made(kind: type, file) -> object:
    """The encoder or decoder of a broadcast tokenizer file; the broadcast keeps it for the later tasks of a worker."""
    held = file.__dict__.setdefault("made", {})
    if kind.__name__ not in held:
        held[kind.__name__] = kind(Vocabulary(file.value))
    return held[kind.__name__]


def _ids(encoder: Encoder, texts: pa.Array) -> pa.ListArray:
    coded = [encoder.encode(t.as_py()) for t in texts]
    ends = np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *coded])))


def _texts(decoder: Decoder, coded: pa.ListArray) -> pa.Array:
    flat = coded.values.fill_null(-1).to_numpy(zero_copy_only=False)
    at = coded.offsets.to_numpy()
    return pa.array([decoder.decode(flat[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.string())


def encode(docs: DataFrame, keys: list[str], text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Columns `keys` and ids array<int>: the whole text of every row as token ids.

    Null and empty texts give an empty array. Rows stay in number and place, repeated rows and null
    keys included; other columns are ignored. Map-only.
    """
    file = shared_file(docs.sparkSession, tokenizer)
    rows = docs.select(*[F.col(k) for k in keys], text_of(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = made(Encoder, file)
        for batch in words.small(batches, len(keys)):
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], _ids(encoder, batch.column(len(keys)))], names=[*keys, "ids"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{kinds}, ids array<int>")


def decode(rows: DataFrame, keys: list[str], ids: str = "ids", tokenizer: str | None = None) -> DataFrame:
    """Columns `keys`, ids and decoded string. A null array gives the empty text, null or unknown
    ids are skipped. Map-only."""
    file = shared_file(rows.sparkSession, tokenizer)
    rows = rows.select(*[F.col(k) for k in keys], F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = made(Decoder, file)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, _texts(decoder, batch.column(len(keys)))], names=[*keys, "ids", "decoded"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{kinds}, decoded string")


def encode_decode(docs: DataFrame, keys: list[str], text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Columns `keys`, ids and decoded: `decode` of `encode` in one pass over the texts. Map-only."""
    file = shared_file(docs.sparkSession, tokenizer)
    rows = docs.select(*[F.col(k) for k in keys], text_of(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = made(Encoder, file), made(Decoder, file)
        for batch in words.small(batches, len(keys)):
            ids = _ids(encoder, batch.column(len(keys)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids, _texts(decoder, ids)], names=[*keys, "ids", "decoded"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{kinds}, ids array<int>, decoded string")


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Per document: doc_id, n_tokens and the digests of its ids and of its decoded text."""
    coded = encode_decode(docs, ["doc_id"], tokenizer=tokenizer)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
