import zlib

import numpy as np

from brandspark.llm.common import read
from brandspark.llm.quality_mil import PASSAGE, WIDTH, fit, held_out, passages, query, score, train
from brandspark.llm.textcore import text_bytes


def test_held_out_accuracy_and_rule(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in read(spark, folder, "labels").collect()}
    rows = query(spark, folder).collect()
    assert len(rows) == read(spark, folder, "documents").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    out = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert np.mean([a == b for a, b in out]) >= 0.95


def test_never_learns_from_held_out_rows(spark):
    docs = spark.createDataFrame([(k, "good words here " * 9 if k % 2 else "### $$$ " * 9) for k in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(60)], "doc_id long, quality int, toxic int")
    other = labels.withColumn("quality", (1 - labels.quality))
    mixed = labels.filter(~held_out(labels.doc_id)).unionByName(other.filter(held_out(other.doc_id)))
    a, b = fit(docs, labels), fit(docs, mixed)
    assert np.array_equal(a.encode, b.encode) and np.array_equal(a.out, b.out)


def test_edges(spark):
    import pyarrow as pa

    first, x = passages(*text_bytes(pa.array([None, "", " \n", "a", "b " * 200])))
    assert first.tolist() == [0, 1, 2, 3, 4, 8] and x.shape == (8, WIDTH)
    docs = spark.createDataFrame([(1, None, 1.0), (1, "", 2.0), (2, "w " * 100_000, 3.0)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in score(docs, fit(docs, none)).collect()} == {0.5}
    assert score(docs.limit(0), train([], np.zeros(0))).count() == 0


def test_training_fits_a_small_table():
    rng = np.random.default_rng(0)
    bags = [rng.random((n, WIDTH)).astype(np.float32) for n in (1, 3, 2, 5) for _ in range(10)]
    labels = np.array([float(b[:, 0].mean() > 0.5) for b in bags], dtype=np.float32)
    model = train(bags, labels, epochs=40)
    first = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    p = model.forward(first, np.concatenate(bags))[0]
    assert np.mean((p >= 0.5) == labels) >= 0.9


def test_score_equals_a_naive_forward_pass(spark):
    """Each document alone, its passages cut word by word, attention by plain sums."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    texts = {k: " ".join(rng.choice(["good", "words", "###", "12", "Here.", "é"], size=int(n))) for k, n in enumerate([0, 1, 63, 64, 65, 128, 700])}
    bags = [rng.random((3, WIDTH)).astype(np.float32) for _ in range(8)]
    model = train(bags, np.array([0, 1] * 4, dtype=np.float32), epochs=2)
    docs = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    got = {r.doc_id: (r.score, r.n_passages) for r in score(docs, model).collect()}
    for k, text in texts.items():
        first, x = passages(*text_bytes(pa.array([text])))
        assert first[-1] == max(1, -(-len(text.split()) // PASSAGE)) == got[k][1]
        hidden, weights = [], []
        for row in x:
            h = np.tanh(row @ model.encode + model.bias)
            gate = np.tanh(h @ model.gate_v) / (1 + np.exp(-(h @ model.gate_u)))
            hidden.append(h)
            weights.append(np.exp(float(gate @ model.attend)))
        z = sum(w * h for w, h in zip(weights, hidden, strict=True)) / sum(weights)
        assert abs(got[k][0] - 1 / (1 + np.exp(-(z @ model.out[:-1] + model.out[-1])))) < 1e-5


def test_sample_takes_whole_texts_and_one_row_of_a_doc_id(spark):
    docs = spark.createDataFrame([(k, "word " * (64 * 25 + k)) for k in range(30)] + [(0, "other")] * 50, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(30)] * 3 + [(None, 1), (2, None), (4, 7)], "doc_id long, quality int")
    seen = []
    import brandspark.llm.quality_mil as module

    original = module.train
    module.train = lambda bags, labels: seen.append(([len(b) for b in bags], labels)) or original([], labels)
    try:
        fit(docs, labels)
        fit(docs, labels, longest=25)
        fit(docs, labels, per_label=3)
    finally:
        module.train = original
    learned = [k for k in range(30) if zlib.crc32(str(k).encode()) % 3 != 1]
    assert len(seen[0][0]) == len(learned) and max(seen[0][0]) == 26
    assert max(seen[1][0]) <= 25 and len(seen[2][0]) == 6
