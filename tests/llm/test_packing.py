import json
import random
import zlib
from collections import defaultdict

import numpy as np

from brandspark.llm.common import read
from brandspark.llm.packing import CAPACITY, Encoder, default_tokenizer, digest, pack, pack_block


def reference_ids(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_tokenizer()[0])
    return [*t.encode(text or "", add_special_tokens=False).ids, 1]


def check(pieces, texts):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(texts)
    for doc, own in by_doc.items():
        ids = np.array(reference_ids(texts[doc]), dtype="<u4")
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= CAPACITY
    return sum(p.length for p in pieces), len(by_sequence)


def test_pieces_round_trip_with_little_padding(spark, sf):
    docs = read(spark, sf, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    tokens, sequences = check(digest(pack(docs, *default_tokenizer(), block_tokens=40_000)).collect(), texts)
    assert tokens > 0.93 * sequences * CAPACITY


def test_edges(spark):
    texts = {0: None, 1: "", 2: "a  b\n c\x00d", 3: "word " * 9000, 4: "<|endoftext|>", 5: "a <|endoftext|><|endoftext|>\n<|endoftext|", 6: "<|endoftext|> " * 3000}
    docs = spark.createDataFrame([(k, v, 7) for k, v in texts.items()], "doc_id long, text string, ids int")
    check(digest(pack(docs, *default_tokenizer())).collect(), texts)
    assert pack(docs.limit(0), *default_tokenizer()).count() == 0
    assert pack(docs.union(docs).coalesce(1), *default_tokenizer()).selectExpr("sum(length)").first()[0] == 2 * sum(
        len(reference_ids(t)) for t in texts.values()
    )


def test_encoder_equals_tokenizer_on_odd_text():
    rng = random.Random(1)
    parts = ["a", "bc", " ", "  ", "\n", "\t", "'s", "'ll", "1", "é", "　", "\xa0", "!", ",", ".", "\0", "日", "\x85", "\x1c", "​", "é"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += [" " * 1_500_000 + "a", "\n" * 120_000, "ab" * 200_000, "x" + "\t " * 60_000 + "y"]
    encoder = Encoder(*default_tokenizer())
    assert encoder.fast is not None and encoder.encode(texts) == [encoder._whole(t) for t in texts]


def test_encoder_equals_tokenizer_on_every_character():
    encoder = Encoder(*default_tokenizer())
    for at in range(0, 0x110000, 0x1000):
        text = "".join(f"a{chr(c)}b {chr(c)}{chr(c)}1 \n{chr(c)}. " for c in range(at, at + 0x1000) if not 0xD800 <= c < 0xE000)
        assert encoder.encode([text]) == [encoder._whole(text)]


def test_other_vocabularies_use_the_tokenizer_itself(tmp_path):
    path, pattern = default_tokenizer()
    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    content["model"]["merges"] = content["model"]["merges"][1:] + content["model"]["merges"][:1]
    (tmp_path / "other.json").write_text(json.dumps(content), encoding="utf-8")
    encoder = Encoder(str(tmp_path / "other.json"), pattern)
    assert encoder.fast is None and encoder.encode(["some text"]) == [encoder._whole("some text")]


def test_cost_is_balanced():
    rng = random.Random(2)
    pieces = pack_block([rng.randint(1, 1500) for _ in range(3000)])
    cost = defaultdict(float)
    for _, _, n, k, _ in pieces:
        cost[k] += n + n * n / CAPACITY
    whole = sum(n for _, _, n, _, _ in pieces)
    assert len(cost) == -(-whole // CAPACITY)
    values = sorted(cost.values())[1:]
    assert values[-1] < 1.5 * values[0]
