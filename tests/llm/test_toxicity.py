import numpy as np
import pyarrow as pa

from docflow.llm.common import utf8
from docflow.llm.toxicity import scores, sentences, train_noisy_or


def tables(spark, n=400):
    rng = np.random.default_rng(5)
    vocabulary = [f"word{i}" for i in range(200)]
    docs, labels = [], []
    for i in range(n):
        parts = [" ".join(rng.choice(vocabulary, 8)) for _ in range(rng.integers(1, 9))]
        toxic = i % 4 == 0
        if toxic:
            at = rng.integers(len(parts))
            parts[at] += rng.choice([" Idiot é", " gröbling", " gröbster"])
        docs.append((i, ". ".join(parts) + ".", "x"))
        labels.append((i, int(toxic)))
    docs += [(n, "", "x"), (n + 1, None, "x"), (None, "you idiot", "x"), (1, docs[1][1], "x"), (n + 2, "idiot " * 60_000, "x")]
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels + [(7, None), (None, 1)], "doc_id long, toxic int")


def test_held_out_documents_and_their_sentences(spark):
    docs, labels = tables(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = scores(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    out = [(r.score >= 0.3, r.doc_id % 4 == 0) for r in got if r.held_out and r.doc_id < 400]
    assert len(out) > 60 and np.mean([a == b for a, b in out]) > 0.95
    found = [texts[r.doc_id][s:e].lower() for r in got if r.doc_id is not None and r.doc_id < 400 and r.score >= 0.3 for s, e in zip(r.sentence_starts, r.sentence_ends)]
    assert np.mean(["idiot" in t or "gröb" in t for t in found]) > 0.9


def test_without_labels_or_rows(spark):
    docs, labels = tables(spark, 20)
    assert {r.score for r in scores(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in scores(docs, labels.filter("toxic = 0")).collect()} == {0.0}
    assert scores(docs.limit(0), labels).count() == 0


def test_sentences():
    text = ["", "One two. Three!\n\n four", "é. x", "..!"]
    _, sentence, doc, start, end = sentences(*utf8(pa.array(text)))
    data, offs = utf8(pa.array(text))
    assert [bytes(data[a:b]).decode() for a, b in zip(start, end)] == ["One two", "Three", "four", "é", "x"]
    assert doc.tolist() == [1, 1, 1, 2, 2] and set(sentence.tolist()) == set(range(5))


def test_noisy_or_blames_the_sentence():
    sentence, doc = np.arange(40), np.repeat(np.arange(20), 2)
    bucket = np.where((sentence % 2 == 0) & (doc < 8), 1, 0)
    w, bias = train_noisy_or(bucket, sentence, doc, (np.arange(20) < 8).astype(float), 2)
    assert w[1] + bias > 1 and w[0] + bias < -1


def test_query_against_plain_scoring(spark, tmp_path):
    """Scores of the query equal noisy-or over sentences written plainly, word by word, with the weights that fit() learns."""
    import re
    import zlib

    from docflow.llm import toxicity

    docs, labels = tables(spark, 200)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    model = toxicity.fit(docs.select("doc_id", "text"), labels)

    def buckets(word):
        data, offs = utf8(pa.array([word]))
        return sentences(data, offs)[0]

    def score(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        none = 1.0
        for part in re.split(r"[.!?\n]", low):
            found = re.findall(r"[0-9a-z\x80-\U0010ffff]+", part)
            if found:
                z = model.bias + sum(model.weights[b] for w in found for b in buckets(w))
                none *= 1 / (1 + np.exp(np.clip(z, -700, 700)))
        total = np.clip(-np.log(max(none, 1e-300)), 1e-6, 50)
        logit = total if total > 30 else np.log(np.expm1(total))
        return 1 / (1 + np.exp(-np.clip(model.slope * logit + model.shift, -50, 50)))

    got = [r for r in toxicity.op3_toxicity(spark, str(tmp_path)).collect()]
    want = {r.doc_id: score(r.text) for r in docs.filter("length(text) < 10000 or text is null").collect()}
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id in want:
            assert abs(r.score - want[r.doc_id]) < 1e-6 and r.predicted == (r.score >= 0.3)
            assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_ids_of_one_remainder_and_repeated_rows(spark):
    """Ids that are all multiples of 4 still leave a part to calibrate on; rows that repeat count once in the fit."""
    from docflow.llm import toxicity
    from pyspark.sql import functions as F

    docs, labels = tables(spark, 240)
    four = lambda df: df.filter("doc_id < 240").withColumn("doc_id", F.col("doc_id") * 4)
    model = toxicity.fit(four(docs).select("doc_id", "text"), four(labels))
    assert (model.slope, model.shift) != (1.0, 0.0)
    many = four(docs).unionByName(four(docs).filter("doc_id = 12").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("n"))
    again = toxicity.fit(many.select("doc_id", "text"), four(labels))
    assert np.allclose(model.weights, again.weights) and model.slope == again.slope
