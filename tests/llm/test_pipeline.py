import random
from pathlib import Path

import pytest

import __spark_entry__ as entries
import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"


def test_stages_are_registered():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near duplicates", "benchmark decontamination", "mixing to target weights", "token ids",
    ]
    assert "pipeline" in entries.queries() and {f"op{n}" for n in range(1, 11)} <= {q.split("_")[0] for q in entries.queries()}


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Clean texts, toxic ones, near copies and passages of the benchmark."""
    folder, pick = tmp_path_factory.mktemp("corpus"), random.Random(1)
    vocabulary = [f"word{n}" for n in range(3000)]

    def text(n=80):
        return ". ".join(" ".join(pick.choices(vocabulary, k=10)) for _ in range(n // 10)) + "."

    rows, labels, kinds = [], [], {}
    for n in range(200):
        kinds[n] = "clean"
        rows.append((n, text(), "en", f"s{n % 3}", 0, "extra"))
    for n in range(200, 260):
        kinds[n] = "toxic"
        rows.append((n, text() + " you awful fiend go away. " + text(30), "en", "s1", 0, "extra"))
    for n in range(260, 290):
        kinds[n] = "copy"
        rows.append((n, rows[n - 260][1] + " end", "en", "s2", 0, "extra"))
    item = " ".join(pick.choices(vocabulary, k=15))
    for n in range(290, 300):
        kinds[n] = "leak"
        rows.append((n, f"{text()} {item} {text(20)}", None, None, None, None))
    labels = [(n, 1, int(kinds[n] == "toxic")) for n in range(260) if n % 2]
    schema = "doc_id long, text string, lang string, source string, n_chars long, toxicity string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), kinds, len(rows[0])


def test_stages_drop_what_they_should_and_no_more(spark, planted, tmp_path):
    folder, kinds, width = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        path = f"{tmp_path}/{name.replace(' ', '-')}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        left[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
    after = {k: {n for n, kind in kinds.items() if kind == k} for k in ("clean", "toxic", "copy", "leak")}
    assert left["toxicity"] == after["clean"] | after["copy"] | after["leak"]
    assert left["near duplicates"] == after["clean"] | after["leak"]
    assert left["benchmark decontamination"] == after["clean"]
    assert left["mixing to target weights"] <= after["clean"]
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert tokens.count() == docs.count()


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")
def test_run(spark):
    rows = sorted(corpus_pipeline.run(spark, SF_DIR).collect(), key=lambda r: r["start"])
    assert rows and all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:], strict=False))
