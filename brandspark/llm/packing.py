"""Cost-balanced packing of documents into training sequences.

Documents are tokenized with a public byte-level BPE; each gets an end token.
A piece of ``n`` tokens costs ``n + n * n / capacity`` (linear work plus
attention inside the piece).  Pieces are assigned in descending length to the
sequence of lowest cost that still has room; a piece that fits nowhere whole is
cut, so that all sequences but the last of a block are full.

Plan: no shuffle.  Each task tokenizes its rows in slices, gathers a block of
at most ``block_tokens`` ids (a parameter, so memory is bounded; one document
may exceed it), packs the block, and emits its pieces with their ids.  Blocks
are independent; each leaves one sequence partly filled.  Sequence ids are
unique by partition number and count, and repeat when a task is run again.

Edge cases: a null or empty text is the end token alone; rows repeat as they
are; ties go by position in the block; other columns of the input are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textcore import slices

CAPACITY = 2048
SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
#: Runs of white space from this length on go to the tokenizer itself: the pattern matcher of the fast encoder gives up on some.
LONG_RUN = 100_000


def _byte_alphabet() -> dict[str, int]:
    """The bytes behind the characters of a byte-level vocabulary: printable ones stand for themselves, the others for U+0100 and on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Token ids of texts as little-endian uint32 bytes, by a byte-level BPE file of the tokenizers library.

    Where the file's merges stand in the order of their ids, as they do in such
    vocabularies, the same ids come faster from a rank-based encoder over the
    file's own vocabulary; otherwise the tokenizer itself does all.  Texts that
    hold the string of an added token also go to the tokenizer, which gives its
    one id.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        model, added = content["model"], {t["content"] for t in content.get("added_tokens", ())}
        vocabulary, of = model["vocab"], _byte_alphabet()
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        made = [vocabulary[a + b] for a, b in pairs]
        self.path, self.slow, self.fast = path, None, None
        self.added = re.compile("|".join(map(re.escape, sorted(added)))) if added else None
        if all(a < b for a, b in zip(made, made[1:], strict=False)):
            import tiktoken

            ranks = {bytes(of[c] for c in token): i for token, i in vocabulary.items() if token not in added}
            self.fast = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def _whole(self, text: str) -> bytes:
        if self.slow is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.path)
        return np.asarray(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        fast = self.fast
        out = []
        for text in texts:
            if fast is None or self.added and self.added.search(text) or len(text) >= LONG_RUN and re.search(r"\s{%d}" % LONG_RUN, text):
                out.append(self._whole(text))
            else:
                out.append(fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes())
        return out


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One encoder for each Python worker; it holds its vocabulary and nothing of the texts."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(path, pattern)
    return _ENCODERS[path, pattern]


def pack_block(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of pieces that cover all documents."""
    out, rest, full = [], [], 0
    for doc, n in enumerate(lengths):
        for start in range(0, n - n % capacity, capacity):
            out.append((doc, start, capacity, full, 0))
            full += 1
        if n % capacity:
            rest.append((-(n % capacity), doc, n - n % capacity))
    heapq.heapify(rest)
    total = -sum(r[0] for r in rest)
    count = -(-total // capacity)
    room = [capacity] * (count - 1) + [total - capacity * (count - 1)] if count else []
    used = [0] * count
    lowest = [(0.0, k) for k in range(count)]
    while rest:
        size, doc, start = heapq.heappop(rest)
        size = -size
        skipped = []
        chosen = None
        while lowest:
            cost, k = heapq.heappop(lowest)
            if room[k] == 0:
                continue
            if room[k] >= size:
                chosen = (cost, k)
                break
            skipped.append((cost, k))
        if chosen is None:  # it fits nowhere whole: fill the roomiest sequence and go on with what is left
            chosen = max(skipped, key=lambda x: (room[x[1]], -x[0], -x[1]))
            skipped.remove(chosen)
        for item in skipped:
            heapq.heappush(lowest, item)
        cost, k = chosen
        n = min(size, room[k])
        out.append((doc, start, n, full + k, used[k]))
        used[k] += n
        room[k] -= n
        if room[k]:
            heapq.heappush(lowest, (cost + n + n * n / capacity, k))
        if n < size:
            heapq.heappush(rest, (n - size, doc, start + n))
    return out


def _packer(path: str, pattern: str, end_id: int, capacity: int, block_tokens: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, pattern).encode
        sequence = TaskContext.get().partitionId() << 36
        docs: list = []
        ids: list[bytes] = []
        tokens = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal docs, ids, tokens, sequence
            pieces = pack_block([len(x) // 4 for x in ids], capacity)
            for at in range(0, len(pieces), 500):
                some = pieces[at : at + 500]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([docs[p[0]] for p in some], pa.int64()),
                        *(pa.array([p[k] for p in some], pa.int64()) for k in (1, 2)),
                        pa.array([len(ids[p[0]]) // 4 for p in some], pa.int64()),
                        pa.array([sequence + p[3] for p in some], pa.int64()),
                        pa.array([p[4] for p in some], pa.int64()),
                        pa.array([ids[p[0]][4 * p[1] : 4 * (p[1] + p[2])] for p in some], pa.binary()),
                    ],
                    names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                )
            sequence += 1 + max((p[3] for p in pieces), default=0)
            docs, ids, tokens = [], [], 0

        for batch in slices(batches, "text", 1 << 20):
            new = [x + end for x in encode([x or "" for x in batch.column(1).to_pylist()])]
            docs += batch.column(0).to_pylist()
            ids += new
            tokens += sum(map(len, new)) // 4
            if tokens >= block_tokens:
                yield from flush()
        if docs:
            yield from flush()

    return run


def pack(docs: DataFrame, tokenizer: str, pattern: str, end_id: int = 1, capacity: int = CAPACITY, block_tokens: int = 2_000_000) -> DataFrame:
    """Pieces of all documents with their ids (little-endian unsigned 32-bit)."""
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(_packer(tokenizer, pattern, end_id, capacity, block_tokens), SCHEMA)


def default_tokenizer() -> tuple[str, str]:
    """Path and pre-token pattern of the public byte-level BPE."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    return digest(pack(read(spark, sf_dir, "documents"), *default_tokenizer()))
