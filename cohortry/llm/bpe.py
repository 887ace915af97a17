"""Byte-pair encoding and decoding with a published vocabulary, by tree concatenation.

A text is cut in halves again and again until a leaf is short. Most cuts fall where the
pre-tokeniser always splits (the character class changes), so the halves' ids just follow each
other. Inside a long run without such a place the cut is a hard one: there the last ids of the
left half and the first of the right half are decoded and encoded again as one window, which
grows until it begins with the left half's id and ends with the right half's id. Neighbouring
ids that stand together in any correct encoding stay correct when joined, so the result is
the encoding of the whole.

Texts over ``spread_chars`` are cut into leaves that Spark encodes in different tasks; the
leaves of one text are then joined in order.

Defined results: a null text is empty; an empty text has no ids and decodes to an empty text;
rows with equal ids are all returned; strings of special tokens count as these tokens.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF_CHARS = 4096
SPREAD_CHARS = 2_000_000
CACHE_ENTRIES = 300_000


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write a byte as itself if it prints, else as the next free code point from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in printable}
    out |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(printable)))}
    return out


def char_class(c: str) -> str:
    """space, letter, number or other, as the pre-tokeniser's pattern tells them apart."""
    kind = unicodedata.category(c)[0]
    if c in "\t\n\v\f\r\x85" or kind == "Z":
        return "space"
    return {"L": "letter", "N": "number"}.get(kind, "other")


def always_split(before: str, after: str) -> bool:
    """True where any text with these neighbours is split between them."""
    a, b = char_class(before), char_class(after)
    return a != b and a != "space" and not (before == "'" and b == "letter")


def halve(text: str, reach: int = 512) -> tuple[int, bool]:
    """Where to cut a text, and whether that is a hard cut: the place nearest to the middle where it is always split."""
    mid = len(text) // 2
    for i in range(min(reach, mid - 1)):
        for at in (mid - i, mid + i):
            if 0 < at < len(text) and always_split(text[at - 1], text[at]):
                return at, False
    if char_class(text[mid - 1]) == "space" or not _one_class(text[mid - reach : mid + reach]):
        places = [i for i in range(1, len(text)) if always_split(text[i - 1], text[i])]
        return (min(places, key=lambda i: abs(i - mid)), False) if places else (0, False)
    return mid, True


def _one_class(text: str) -> bool:
    return len({char_class(c) for c in text}) == 1


class ByteBPE:
    """The vocabulary of a ``tokenizers`` JSON file of the byte-level kind."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec["model"].get("ignore_merges"):
            raise ValueError(f"{path}: only byte-level BPE without normalizer is read")
        byte = _byte_of_char()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.special = special
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.bytes_of = [b""] * (max([*ranks.values(), *special.values()]) + 1)
        for b, i in ranks.items():
            self.bytes_of[i] = b
        for s, i in special.items():
            self.bytes_of[i] = s.encode()
        self.opens = np.array([b.startswith(b" ") for b in self.bytes_of])
        self.plain: dict[str, bytes | None] = {}
        self.decimals = [b"%d," % i for i in range(len(self.bytes_of))]

    @staticmethod
    def pack(ids: list[int]) -> bytes:
        return array("I", ids).tobytes()

    def to_decimal(self, packed: bytes) -> bytes:
        """The ids in decimal, each followed by a comma."""
        return b"".join(map(self.decimals.__getitem__, np.frombuffer(packed, "<u4").tolist()))

    def _chunks(self, chunks: list[str]) -> dict[str, bytes | None]:
        """Ids of a space and each chunk, encoded in one go; None where the chunk's neighbours would matter.

        A space between two other characters is always split before, and only there does an id begin with one.
        """
        good = [c for c in chunks if c and not c[0].isspace() and not c[-1].isspace() and len(c) < LEAF_CHARS]
        ids = np.array(self.encoding.encode_ordinary(" " + " ".join(good)) if good else [], "<u4")
        at = np.flatnonzero(self.opens[ids]) * 4
        packed = ids.tobytes()
        out = dict.fromkeys(chunks)
        out |= {c: packed[i:j] for c, i, j in zip(good, at.tolist(), [*at[1:].tolist(), len(packed)][: len(good)], strict=True)}
        return out | {c: self.pack(self.tree(" " + c)) for c in chunks if len(c) >= LEAF_CHARS and not c[0].isspace() and not c[-1].isspace()}

    def tree(self, text: str, leaf: int = LEAF_CHARS) -> list[int]:
        """Ids of a text without special tokens."""
        if len(text) <= leaf:
            return self.encoding.encode_ordinary(text)
        at, hard = halve(text)
        if not at:
            return self.encoding.encode_ordinary(text)
        left, right = self.tree(text[:at], leaf), self.tree(text[at:], leaf)
        return self.join(left, right) if hard else left + right

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Ids of the text of ``left`` followed by that of ``right``, inside one run without a split."""
        k = 2
        while True:
            a, b = left[-k:], right[:k]
            window = b"".join(map(self.bytes_of.__getitem__, a + b))
            try:
                ids = self.encoding.encode_ordinary(window.decode())
            except UnicodeDecodeError:  # an id holds part of a character: the window needs the rest of it
                ids = None
            whole_left, whole_right = k >= len(left), k >= len(right)
            if ids and (whole_left or ids[0] == a[0]) and (whole_right or ids[-1] == b[-1]):
                return left[: len(left) - len(a)] + ids + right[len(b) :]
            k *= 2

    def encode(self, text: str | None) -> bytes:
        return self.encode_batch([text])[0]

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        known = self.plain
        split = [self._special_apart(t) for t in texts]
        parts = [t.split(" ") for own in split for t in own if isinstance(t, str)]
        new = list(set().union(*(p[1:] for p in parts)).difference(known))
        known.update(self._chunks(new))
        out, n = [], 0
        for own in split:
            done = []
            for t in own:
                if isinstance(t, int):
                    done.append(self.pack([t]))
                    continue
                first, *rest = parts[n]
                n += 1
                try:
                    if first[-1:].isspace():
                        raise TypeError
                    found = b"".join(map(known.__getitem__, rest))
                    done += [self.pack(self.tree(first)), found]
                except TypeError:  # spaces beside spaces
                    done.append(self.pack(self.tree(t)))
            out.append(b"".join(done))
        if len(known) > CACHE_ENTRIES:
            for c in new:
                del known[c]
        return out

    def _special_apart(self, text: str | None) -> list[str | int]:
        """The text's parts, with special tokens as their ids."""
        if not text:
            return []
        if not any(s in text for s in self.special):
            return [text]
        return [self.special.get(t, t) for t in self.split_special.split(text) if t]

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> ByteBPE:
    """Read once by each Python worker."""
    return ByteBPE(path)


def leaves(text: str, size: int) -> list[tuple[str, bool]]:
    """Leaves of at most ``size`` characters where it can be cut, each with whether a hard cut is before it."""
    if len(text) <= size:
        return [(text, False)]
    at, hard = halve(text)
    if not at:
        return [(text, False)]
    right = leaves(text[at:], size)
    return leaves(text[:at], size) + [(right[0][0], hard)] + right[1:]


def _result(doc_ids, encoded: list[bytes], bpe: ByteBPE) -> pa.RecordBatch:
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return pa.RecordBatch.from_arrays(
        [
            doc_ids,
            pa.array([len(ids) // 4 for ids in encoded], pa.int64()),
            pa.array([sha(bpe.to_decimal(ids)[:-1]) for ids in encoded], pa.string()),
            pa.array([sha(bpe.decode(ids).encode()) for ids in encoded], pa.string()),
        ],
        names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    )


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """Columns ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded`` for each row of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                ids = bpe.encode_batch(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array([bpe.decode(x) for x in ids], pa.string())], names=["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids binary, decoded string")


def encode_digests(docs: DataFrame, path: str, spread_chars: int = SPREAD_CHARS) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                yield _result(part.column(0), bpe.encode_batch(part.column(1).to_pylist()), bpe)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, key, copies, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                found = leaves(text, spread_chars // 8)
                for i, (leaf, hard) in enumerate(found):
                    yield pa.RecordBatch.from_pylist([{"doc_id": doc_id, "key": key, "copies": copies, "leaf": i, "hard": hard, "text": leaf}], schema=pa.schema([("doc_id", pa.int64()), ("key", pa.string()), ("copies", pa.int64()), ("leaf", pa.int32()), ("hard", pa.bool_()), ("text", pa.string())]))

    def encode_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            texts = batch.column(5).to_pylist()
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), pa.array([bpe.pack(bpe.tree(t)) for t in texts], pa.binary())], names=["doc_id", "key", "copies", "leaf", "hard", "ids"])

    def joined(group: pa.Table) -> pa.Table:
        bpe = vocabulary(path)
        group = group.sort_by("leaf")
        out: list[int] = []
        for hard, ids in zip(group.column("hard").to_pylist(), group.column("ids").to_pylist(), strict=True):
            right = np.frombuffer(ids, "<u4").tolist()
            out = bpe.join(out, right) if hard else out + right
        packed = bpe.pack(out)
        row = _result(group.column("doc_id").combine_chunks()[:1], [packed], bpe)
        return pa.Table.from_batches([row] * group.column("copies")[0].as_py())

    long = F.length("text") > spread_chars
    for s in json_special(path):  # texts with special tokens are cut at these, in one task
        long = long & ~F.contains("text", F.lit(s))
    short = rows.filter(~long).mapInArrow(whole, SCHEMA)
    spread = (
        rows.filter(long)
        .groupBy("doc_id", F.sha2("text", 256).alias("key"))
        .agg(F.count(F.lit(1)).alias("copies"), F.first("text").alias("text"))
        .mapInArrow(cut, "doc_id long, key string, copies long, leaf int, hard boolean, text string")
        .repartition("doc_id", "key", "leaf")
        .mapInArrow(encode_leaves, "doc_id long, key string, copies long, leaf int, hard boolean, ids binary")
        .groupBy("doc_id", "key")
        .applyInArrow(joined, SCHEMA)
    )
    return short.unionByName(spread)


def json_special(path: str) -> list[str]:
    with open(path, encoding="utf-8") as f:
        return [t["content"] for t in json.load(f)["added_tokens"]]
