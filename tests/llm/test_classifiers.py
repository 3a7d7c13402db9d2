import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlake.llm import neighbours, toxicity
from matchlake.llm.labelled import held_out, sample
from matchlake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, toxicity int, quality int, row int"


def labelled(frame, n=240):
    harmless = ["the sun rises", "a quiet morning", "we read books", "trees are green"]
    rows, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        sentences = [harmless[(i + k) % 4] for k in range(4 + i % 5)]
        if bad:
            sentences.insert(i % 4, f"you are a {['fiend', 'villain'][i % 2]} today")
        text = ". ".join(sentences) + "."
        rows.append((i, text.upper() + " !! ###" if i % 4 == 0 else text, 1, 2, 3))
        labels.append((i, int(i % 4 != 0), int(bad)))
    return frame(rows, SCHEMA), frame(labels, "doc_id long, quality int, toxic int")


def test_sample_is_bounded_and_leaves_out_what_is_held_out(frame):
    docs, labels = labelled(frame)
    texts, sizes = sample(docs, labels, "toxic", 20)
    out = labels.where(held_out(F.col("doc_id"))).count()
    assert 0 < out < 80 and sum(sizes.values()) == 240 - out
    assert sorted(y for _, y in texts) == [0] * 20 + [1] * 20


def test_a_repeated_document_is_sampled_once(frame):
    docs, labels = labelled(frame)
    most = docs.join(labels.where(~held_out(F.col("doc_id"))), "doc_id").agg(F.max("doc_id")).first()[0]
    again = docs.where(F.col("doc_id") == most).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("copy")
    other = frame([(most, "~ the largest text", 1, 2, 3)], SCHEMA)
    assert sample(docs.unionByName(again).unionByName(other), labels, "toxic", 240) == sample(docs, labels, "toxic", 240)


def test_sentences_are_found_from_labels_of_documents(frame):
    docs, labels = labelled(frame)
    model = toxicity.fit(docs, labels)
    extra = [(900, None, 1, 2, 3), (901, "", 1, 2, 3), (902, "no end " * 100_000, 1, 2, 3), (None, "You FIEND", 1, 2, 3)]
    more = docs.unionByName(frame(extra, SCHEMA))
    scored = toxicity.score(more, model)
    assert scored.columns == ["doc_id", "text", "quality", "row", "toxicity", "toxic_sentences"]
    for r in scored.collect():
        assert 0 <= r["toxicity"] <= 1
        bad = "fiend" in (r["text"] or "").lower() or "villain" in (r["text"] or "").lower()
        assert (r["toxicity"] >= 0.5) == bad, r
        for s in r["toxic_sentences"]:
            part = r["text"][s["begin"] : s["end"]].lower()
            assert ("fiend" in part or "villain" in part) and "." not in part
        assert bool(r["toxic_sentences"]) == bad
    kept = toxicity.without_toxic(more, labels)
    assert kept.columns == more.columns and kept.where("doc_id IS NULL").isEmpty() and kept.where("doc_id = 900").count() == 1


def test_neither_length_nor_repeats_make_a_document_toxic(frame):
    model = toxicity.fit(*labelled(frame))
    once = "the sun rises. you said fiendish"
    assert model.toxicity(model.sentences("a quiet morning. " * 100_000)) == model.toxicity(model.sentences("a quiet morning"))
    assert model.toxicity(model.sentences(f"{once}. " * 10_000)) == model.toxicity(model.sentences(once))


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")
def test_clean_document_of_ten_thousand_real_sentences(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    clean = docs.join(labels.where(held_out(F.col("doc_id")) & (F.col("toxic") == 0)), "doc_id").orderBy("doc_id")
    sentences = [s for r in clean.collect() for s in re.findall(r"[^.?\n]+", r["text"] or "") if toxicity.tokens(s)]
    mild = [s for s in sentences if model.logit(model.sentences(s)[0]) < np.log(0.2 / 0.8)][:10_000]
    insult = "you worthless scum, stupid pathetic trash"
    rows = [(1, ".\n".join(mild)), (2, ".\n".join([*mild[:5_000], insult, *mild[5_000:]]))]
    long_, found = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert len(mild) == 10_000 and long_["toxicity"] < 0.5 and long_["toxic_sentences"] == []
    assert found["toxicity"] >= 0.5
    assert [found["text"][s["begin"] : s["end"]] for s in found["toxic_sentences"]] == [insult]


def test_noisy_or():
    logits = np.array([0.3, -2.0, 1.0])
    assert toxicity.noisy_or(logits) == pytest.approx(1 - np.prod(1 - 1 / (1 + np.exp(-logits))))
    assert toxicity.noisy_or(np.empty(0)) == 0


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(1, 0, 0), (None, None, None)]])
def test_classifiers_without_much_to_learn(frame, labels):
    docs = frame([(1, "a b", 1, 1, 1), (2, None, 1, 1, 1)], SCHEMA)
    given = frame(labels, "doc_id long, quality int, toxic int")
    for module in (toxicity, neighbours):
        assert module.score(docs, module.fit(docs, given)).count() == 2
        assert module.score(docs.limit(0), module.fit(docs.limit(0), given)).collect() == []


def test_votes_against_all_cosines():
    random = np.random.default_rng(0)
    vectors = neighbours._unit(random.standard_normal((40, 5))).astype(np.float32)
    labels = random.integers(0, 2, 40)
    model = neighbours.Model(np.ones(1), np.eye(1), vectors, labels, np.array([0.5, 1.0]))
    asked = neighbours._unit(random.standard_normal((9, 5))).astype(np.float32)
    for got, vector in zip(model.votes(asked, 7), asked, strict=True):
        cosines = [float(vector @ v) for v in vectors]
        near = sorted(range(40), key=lambda k: -cosines[k])[:7]
        weight = [max(cosines[k], 0) ** 2 * model.weights[labels[k]] for k in near]
        assert got == pytest.approx(sum(w * labels[k] for w, k in zip(weight, near, strict=True)) / sum(weight), abs=1e-4)


def test_texts_without_words_have_the_share_of_all_labels(frame):
    docs, labels = labelled(frame)
    model = neighbours.fit(docs, labels)
    share = labels.where(~held_out(F.col("doc_id"))).agg(F.avg("quality")).first()[0]
    assert len(model.labels) > neighbours.NEIGHBOURS
    empty = frame([(1, None, 1, 1, 1), (2, "", 1, 1, 1), (3, " \n", 1, 1, 1)], SCHEMA)
    assert [r["quality"] for r in neighbours.score(empty, model).collect()] == pytest.approx([share] * 3)


def test_document_frequencies_cover_all_documents(frame):
    docs, _ = labelled(frame)
    counter = neighbours.Counter()
    found = sum((counter(r["text"]) > 0).astype(int) for r in docs.collect())
    assert neighbours.inverse_frequencies(docs.repartition(7)) == pytest.approx(np.log(241 / (1 + found)))


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")
@pytest.mark.parametrize(
    ("name", "label", "recall", "precision"), [("op8_toxic_sentences", "toxic", 0.8, 0.9), ("op10_quality_neighbours", "quality", 0.98, 0.98)]
)
def test_held_out_accuracy(spark, name, label, recall, precision):
    found = QUERIES[name](spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/labels.parquet"), "doc_id").where("held_out")
    hit, real, said = (F.count_if(F.expr(x)) for x in (f"predicted = 1 AND {label} = 1", f"{label} = 1", "predicted = 1"))
    counts = found.agg(hit.alias("hit"), real.alias("real"), said.alias("said")).first()
    assert counts["hit"] >= recall * counts["real"] and counts["hit"] >= precision * counts["said"]


def test_sentences_of_texts_of_many_words_are_not_remembered():
    model = toxicity.Model(-8.0, {b"bad": 5.0, b"\x02wors": 1.0, b"\x02worst": 2.0})
    before = {name: value for name, value in vars(model).items() if name != "_prefixes"}
    text = "Bad " + " ".join(f"n{i}" for i in range(5000)) + ". .worstever, bad?\n fine \x01 x"
    assert model.sentences(text) == [{b"bad"}, {b"bad", b"\x02worst"}, set()]
    assert model.sentences(None) == [] and model.sentences("..?") == []
    assert {name: value for name, value in vars(model).items() if name != "_prefixes"} == before
    assert not any(isinstance(value, dict) and len(value) > 3 for value in vars(model).values())
