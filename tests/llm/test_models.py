from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlake.llm import language_id, queries, toxicity
from adlake.llm.shared import utf8
from samples import prose



@pytest.fixture(scope="module")
def network():
    import random

    draw = random.Random(1)
    kinds = {"aa": ["eau", "oux", "ment", "é"], "bb": ["sch", "ung", "keit", "ö"]}
    texts = [(" ".join("".join(draw.choices(parts, k=3)) for _ in range(60)), lang) for lang, parts in kinds.items() for _ in range(40)]
    return language_id.train([utf8(t) for t, _ in texts], [lang for _, lang in texts]), texts


def test_windows_cover_every_filter_place_once():
    for size in (0, 1, 255, 256, 257, 509, 5000):
        own = language_id.windows(bytes(range(1, 251)) * 20 if size == 5000 else b"x" * size)
        places = len(own) * language_id.STRIDE
        assert places >= max(1, size - 3) and places - language_id.STRIDE < max(1, size - 3)


def test_tables_are_the_convolution(network):
    model = network[0]
    values = np.frombuffer(utf8(network[1][0][0])[:256].ljust(256, b"\0"), np.uint8)[None]
    embedded = model.embedding[values[0]]
    pooled = np.array([
        max(sum(embedded[at + k] @ model.kernel[k, :, f] for k in range(4)) + model.bias[f] for at in range(language_id.STRIDE))
        for f in range(model.bias.size)
    ])
    logits = np.maximum(pooled, 0) @ model.out + model.out_bias
    expected = logits - np.log(np.exp(logits - logits.max()).sum()) - logits.max()
    assert np.allclose(language_id.window_log_odds(model, model.pair_tables(), values)[0], expected, atol=1e-3)


def test_languages_are_told_apart(network):
    model, texts = network
    best, score = language_id.predict(model, model.pair_tables(), [utf8(text) * 7 for text, _ in texts])
    assert np.mean([model.languages[at] == lang for at, (_, lang) in zip(best, texts)]) == 1
    assert ((score >= 0) & (score <= 1)).all()


def test_undetermined_rows(odd, empty):
    found = language_id.identify(odd.withColumn("score", F.lit("clash")), F.lit(True)).collect()
    assert len(found) == odd.count()
    for row in found:
        plain = row["text"] is None or not any(map(str.isalpha, row["text"]))
        assert (row["lang_pred"] == "und") == plain and 0 <= row["score"] <= 1
    assert language_id.identify(empty, F.lit(True)).count() == 0
    assert {row["lang_pred"] for row in language_id.identify(odd, F.lit(False)).collect()} == {"und"}


def test_language_of_held_out_documents(spark):
    found = queries.op3_language_id(spark, "/root/testdata/sf0.01")
    told = found.where("held_out").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert told.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_toxicity_slopes():
    """Back-propagation against differences of the loss."""
    texts, labels = ["one two three four " * 9, "five six idiot seven"], np.array([0, 1], np.float32)
    model = toxicity.train(texts, [0, 1], least_epochs=1, least_steps=1, least_texts=1)
    p = {name: value.astype(np.float64) for name, value in model.p.items()}
    split = [toxicity.WORD.findall(text) for text in texts]
    words = sorted({word for own in split for word in own})
    coded = [np.array([words.index(word) for word in own]) for own in split]
    ids = np.array([model.vocabulary[word] for word in words])
    grams = np.split(*[(g, s[1:]) for g, s in [toxicity.trigrams(words)]][0])

    class Never:
        @staticmethod
        def random(n):
            return np.ones(n)

    def loss():
        scorer = toxicity.Recurrent(model.vocabulary, p)
        gates = scorer.inputs(words).astype(np.float64)
        total = 0
        for own, y in zip(coded, labels):
            places = toxicity.window_places(len(own))
            logit = toxicity.window_logits(p, gates[:, own[np.maximum(places, 0)]], (places >= 0).astype(np.float64)).max()
            total += np.logaddexp(0, logit) - y * logit if not y else 2 * (np.logaddexp(0, logit) - logit)
        return total / len(coded)

    slopes = toxicity._slopes(p, coded, labels, ids, grams, Never)
    for name in ("out", "attention", "u_forward", "u_backward", "w_forward", "b_backward"):
        at = np.unravel_index(np.abs(slopes[name]).argmax(), slopes[name].shape)
        kept, step = p[name][at], 1e-2
        p[name][at] = kept + step
        high = loss()
        p[name][at] = kept - step
        low = loss()
        p[name][at] = kept
        assert slopes[name][at] == pytest.approx((high - low) / (2 * step), rel=0.1, abs=2e-4), name


def test_toxic_words_are_found_anywhere(spark, make, odd, empty):
    rows = [(at, prose(at, 60, 50) + (" you idiot " if at % 3 == 0 else " ") + prose(at + 999, 60, 50)) for at in range(240)]
    labels = spark.createDataFrame([(at, 1, int(at % 3 == 0)) for at in range(200)], "doc_id long, quality int, toxic int")
    docs = make(rows + [(500, prose(1, 3000, 50) + " idiot " + prose(2, 3000, 50))])
    scores = {row["doc_id"]: row for row in toxicity.score_toxicity(docs, labels, F.lit(True)).collect()}
    assert all(scores[at]["predicted"] == int(at % 3 == 0) for at in range(200, 240)) and scores[500]["predicted"] == 1
    found = toxicity.score_toxicity(odd.withColumn("score", F.lit("clash")), labels, F.lit(True)).collect()
    assert len(found) == odd.count() and all(0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.5) for row in found)
    none = toxicity.score_toxicity(odd, labels.where("false"), F.lit(True)).collect()
    assert {row["score"] for row in none} == {0.0}
    assert toxicity.score_toxicity(empty, labels, F.lit(True)).count() == 0


def test_long_runs_are_read_to_their_end():
    for size in (1, 31, 32, 33, 63, 64, 65, 96, 97, 128, 129, 1000):
        run = "".join(chr(0x4E00 + at) for at in range(size))
        own = toxicity.words_of(f"Go {run}, on")
        assert own[0] == "go" and own[-1] == "on" and max(map(len, own)) <= 64
        assert own[1:-1] == [run] if size <= 64 else set().union(*({word[at : at + 3] for at in range(len(word) - 2)} for word in own[1:-1])) == {run[at : at + 3] for at in range(size - 2)}
    texts = [("我们今天去公园散步" * 12 + end * 4, label) for end, label in (("坏话脏话", 1), ("鲜花绿树", 0)) for _ in range(8)]
    scorer = toxicity.Scorer(toxicity.train([text for text, _ in texts], [label for _, label in texts]))
    toxic, clean = scorer.scores([texts[0][0], texts[-1][0]])
    assert toxic > 0.5 > clean


def test_held_out_languages_of_the_tables(spark):
    """The query over whole tables: what it never learned from is right, but for few."""
    found = queries.op3_language_id(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    told = found.join(docs, "doc_id").where("held_out AND lang IS NOT NULL AND lang_pred != 'und'")
    rows, right = told.agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert rows > 100 and right / rows > 0.98


def test_held_out_toxicity_of_the_tables(spark):
    """Ranking and decision over the held-out labels of the larger tables."""
    found = queries.op5_toxicity(spark, "/root/testdata/sf0.1").where("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    rows = found.join(labels, "doc_id").select("score", "predicted", "toxic").collect()
    bad = [row for row in rows if row["toxic"] == 1]
    good = [row for row in rows if row["toxic"] == 0]
    ranks = {score: at for at, score in enumerate(sorted({row["score"] for row in rows}))}
    above = sum((ranks[b["score"]] > ranks[g["score"]]) + 0.5 * (ranks[b["score"]] == ranks[g["score"]]) for b in bad for g in good)
    assert len(bad) > 20 and above / (len(bad) * len(good)) > 0.93
    assert sum(row["predicted"] for row in bad) / len(bad) > 0.8
    assert sum(row["predicted"] for row in good) / len(good) < 0.05


def test_every_label_is_learned_and_gives_its_share(spark, make, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_ROWS", 40)
    docs = make([(n, f"text number {n} of {n % 10}", f"l{n % 10}") for n in range(2000)])
    sample = language_id.training_sample(docs, F.lit(True), 600)
    again = language_id.training_sample(docs.repartition(7), F.lit(True), 600)
    assert sample == again and {lang for _, lang in sample} == {f"l{n}" for n in range(10)}
    assert len(sample) <= 10 * 4 * 2


def test_a_long_text_is_learned_from_and_the_sample_is_bounded(spark, make):
    draw = lambda n: "word " * (n % 7 + 1) + str(n)
    docs = make([(n, draw(n) if n else "long " * 30_000) for n in range(300)])
    labels = spark.createDataFrame([(n, n % 2) for n in range(300)], "doc_id long, toxic int")
    whole = toxicity.training_sample(docs, labels, F.lit(True))
    assert len(whole) == 300 and max(len(text) for text, _ in whole) == 150_000
    few = toxicity.training_sample(docs, labels, F.lit(True), chars=1000)
    assert all(sum(len(text) for text, toxic in few if toxic == kind) <= 1000 for kind in (0, 1)) and 20 < len(few) < 120
    assert few == toxicity.training_sample(docs.repartition(5), labels, F.lit(True), chars=1000)
