"""Packing documents into sequences by shortest-pack-first over the length histogram.

Each document is tokenized, ended by an end id and cut at multiples of the sequence length; what is left of it is one
more piece. Only the histogram of piece lengths (as many rows as a sequence has tokens, whatever the corpus) comes to
the driver. Lengths are placed longest first, each into the emptiest pack that still takes it; packs of one pattern
are one count, which is split where fewer pieces than packs are left. Every placement is a slot: the pieces of one
length with ranks from a to b go to the sequences from s on, at one offset. Pieces are numbered within their length
(salted by hash, so that a length that a third of all pieces have is no single group) and look up their slot.

Where a tokenizer's own file says that it normalizes and splits texts by the rules in ``WORD_RULES``, a text's ids are
those of its words one after the other, and words are remembered; with any other tokenizer each text is encoded whole.

Null and empty texts are the end id alone. Repeated rows are packed each. Extra columns are ignored. Texts are
tokenized whole; ``cache`` words at most are remembered by a worker.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.llm.common import by_chunk, stored, prepare

SEQUENCE, END = 4096, 2
#: Characters for which a text's ids are its parts' ids, one after the other: in Latin-1, NFC and lower-casing change
#: single characters only. Parts are runs of letters, runs of other marks (an apostrophe with what follows it is one
#: part, whatever the tokenizer makes of it) and single digits.
_PLAIN = re.compile(r"[\t\n\x0b\x0c\r\x20-\x7e\xa0-\xff]*").fullmatch
_L, _N = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾"
_SPLIT = re.compile(rf"[{_L}]+(?:[^\s{_N}{_L}]*'[^\s]*)?|[{_N}]|[^\s{_L}{_N}']+(?:'[^\s]*)?|'[^\s]*").findall
_SPECIAL = re.compile(r"<\|(startoftext|endoftext)\|>").search
#: The normalizer and the pre-tokenizer, as a tokenizer's JSON file states them, under which _SPLIT's parts
#: are encoded one by one.
WORD_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
#: The added tokens that _SPECIAL knows of; a tokenizer with others is not split by words.
KNOWN_SPECIAL = {"<|startoftext|>", "<|endoftext|>"}
_PIECES = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long"


def _little(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


#: Of this process, by tokenizer: a worker that runs many tasks keeps its words.
_ENCODERS: dict[tuple, Encoder] = {}


def encoder_of(tokenizer: str, cache: int) -> Encoder:
    key = zlib.crc32(tokenizer.encode()), len(tokenizer)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(tokenizer, cache)
    return _ENCODERS[key]


def splits_by_words(tokenizer: str) -> bool:
    """Whether the tokenizer's file states the rules by which texts are split here."""
    told = json.loads(tokenizer)
    same = all(told.get(k) == rule for k, rule in WORD_RULES.items())
    return same and told["model"].get("type") == "BPE" and not told["model"].get("dropout") and {t["content"] for t in told.get("added_tokens", ())} <= KNOWN_SPECIAL


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers, with a bounded memory of words."""

    def __init__(self, tokenizer: str, cache: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encode = Tokenizer.from_str(tokenizer).encode_batch_fast
        self.by_words = splits_by_words(tokenizer)
        self.known: dict[str, bytes] = {}
        self.cache = cache

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [_little(e.ids) for e in self.encode(texts, add_special_tokens=False)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        plain = [self.by_words and _PLAIN(t) is not None and not _SPECIAL(t) for t in texts]
        split = [_SPLIT(t.lower()) if p else () for t, p in zip(texts, plain, strict=True)]
        known = self.known
        if len(known) > self.cache:
            known.clear()
        new = list(set().union(*split).difference(known))
        for a in range(0, len(new), 4096):
            known.update(zip(new[a : a + 4096], self._ids(new[a : a + 4096]), strict=True))
        get = known.__getitem__
        return [b"".join(map(get, ws)) if p else self._ids([t])[0] for t, ws, p in zip(texts, split, plain, strict=True)]


def _pieces(tokenizer: str, cache: int, sequence: int) -> Callable:
    last = int(END).to_bytes(4, "little")

    def run(batches):
        encoder = encoder_of(tokenizer, cache)

        def work(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
            doc, start, length, crc, total = [], [], [], [], []
            ids = batch.column("doc_id").to_pylist()
            for i, raw in enumerate(encoder([t.decode() for t in texts])):
                raw += last
                n = len(raw) // 4
                for a in range(0, n, sequence):
                    piece = raw[4 * a : 4 * (a + sequence)]
                    doc.append(ids[i])
                    start.append(a)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(n)
            return pa.record_batch([pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int32()), pa.array(crc, pa.int64()), pa.array(total, pa.int64())], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

        yield from by_chunk(work)(batches)

    return run


def place(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first rank, pieces, first sequence, offset) of shortest-pack-first packing."""
    packs: dict[int, list[tuple[int, int]]] = {}  # space left -> (first sequence, sequences)
    spaces: list[int] = []
    slots, sequences = [], 0

    def put(space: int, first: int, n: int) -> None:
        if space:
            if space not in packs:
                packs[space] = []
                insort(spaces, space)
            packs[space].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            if spaces and spaces[-1] >= length:
                space = spaces[-1]
                first, n = packs[space].pop()
                if not packs[space]:
                    del packs[space]
                    spaces.pop(bisect_left(spaces, space))
                if n > left:
                    put(space, first + left, n - left)
                    n = left
                slots.append((length, rank, n, first, sequence - space))
                put(space - length, first, n)
                rank += n
                left -= n
            else:  # no pack takes the length: a new one does, and is the emptiest for as many more as it holds
                per = min(left, sequence // length)
                n = left // per
                for j in range(per):
                    slots.append((length, rank, n, sequences, j * length))
                    rank += n
                put(sequence - per * length, sequences, n)
                sequences += n
                left -= n * per
    return slots


def _look_up(slots: list[tuple[int, int, int, int, int]]) -> Callable:
    table = np.array(sorted(slots), np.int64).reshape(-1, 5)

    def run(batches):
        lengths, begin = np.unique(table[:, 0], return_index=True)
        end = np.concatenate((begin[1:], [len(table)]))
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.empty(len(length), np.int64)
            for x in np.unique(length):
                i = np.searchsorted(lengths, x)
                own = length == x
                at[own] = begin[i] + np.searchsorted(table[begin[i] : end[i], 1], rank[own], "right") - 1
            s = table[at]
            cols = [batch.column("doc_id"), batch.column("start"), batch.column("length").cast(pa.int64()), batch.column("ids_crc32"), batch.column("doc_tokens"), pa.array(s[:, 3] + rank - s[:, 1]), pa.array(s[:, 4])]
            yield pa.record_batch(cols, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, *, sequence: int = SEQUENCE, cache: int = 690_000) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) for each piece of docs (doc_id, text).

    tokenizer: the text of a tokenizer's JSON file.
    """
    prepare(docs.sparkSession)
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_pieces(tokenizer, cache, sequence), _PIECES)
    pieces = stored(pieces, "pieces")
    histogram = {r.length: r["count"] for r in pieces.groupBy("length").count().toLocalIterator()}
    slots = place(histogram, sequence)
    salts = max(16, max(histogram.values(), default=0) // 50_000)
    dealt = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts)).cast("int"))
    before = dealt.groupBy("length", "salt").count().withColumn("before", F.sum("count").over(W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1))).select("length", "salt", F.coalesce("before", F.lit(0)).alias("before"))
    own = F.row_number().over(W.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32"))
    ranked = dealt.withColumn("own", own).join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("own") - 1)
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank").mapInArrow(_look_up(slots), schema)


def tokenizer_text(path: str) -> str:
    """A tokenizer file's text, read on the driver; workers get it with the code."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return tokenizer_text(public_tokenizers.path(name))
