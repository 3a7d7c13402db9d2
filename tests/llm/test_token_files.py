import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from matchlake.llm import token_files
from matchlake.llm.queries import END_ID, tokenizer_file
from matchlake.llm.token_files import Encoder, pack, unpack
from matchlake.session import shared_folder


@given(st.lists(st.integers(0, 2**32 - 1), max_size=70))
def test_code_round_trip(values):
    control, data = pack(np.array(values, np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert len(data) == sum(max(1, -(-v.bit_length() // 8)) for v in values)
    assert unpack(control, data, len(values)).tolist() == values


def test_code_round_trip_of_several_blocks():
    values = np.random.default_rng(1).integers(0, 2**20, 10_001).astype(np.uint32)
    assert (unpack(*pack(values), len(values), block=64) == values).all()


@pytest.fixture(scope="module")
def encoder():
    return Encoder(tokenizer_file())


def test_encoder_equals_the_tokenizer(encoder):
    random.seed(2)
    parts = ["a", "é", "ß", " ", "  ", "\n", "\n\n", "'s", "can't", ",", ".", "...", "1", "23", "!", "\t", "<|endoftext|>", "日本", "_", "\xa0", "Ab", "ª"]
    for _ in range(20_000):
        text = "".join(random.choices(parts, k=random.randint(0, 12)))
        assert encoder(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_texts_of_one_batch_keep_their_ids_apart(encoder):
    random.seed(5)
    parts = ["a", "é ", " the", " the,", " The.", "\n", "\nthe", "'s", ",.", " ", "1", "\x0b", "\x85", "<|endoftext|>", " 日本.", "\xa0", "word"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 9))) for _ in range(5_000)] + [None]
    ids, counts = encoder.texts(pa.array(texts))
    expected = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(x) for x in expected] and ids.tolist() == [x for e in expected for x in e]


def test_encoder_of_another_kind_goes_text_by_text():
    import public_tokenizers

    other = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert not other.by_piece
    assert other("Hello  there").tolist() == other.tokenizer.encode("Hello  there", add_special_tokens=False).ids


def written(spark, docs, **options):
    path = shared_folder(spark, "tokens")
    token_files.write_tokens(docs, path, tokenizer_file(), END_ID, **options)
    return path


@pytest.mark.parametrize("shard_ids", [1, 40, 1_000_000])
def test_files_round_trip_in_order(spark, frame, encoder, shard_ids):
    texts = [(n, f"text number {n} " * (n % 7)) for n in range(60)] + [(60, None), (61, ""), (5, "again"), (None, "no id")]
    docs = frame([(*t, "x", 1) for t in texts], "doc_id long, text string, part string, offset int").repartition(3)
    path = written(spark, docs, shard_ids=shard_ids)
    digests = sorted(token_files.token_digests(spark, path).collect(), key=lambda r: r["start"])
    assert [(r["doc_id"] is not None, r["doc_id"] or 0) for r in digests] == sorted((t[0] is not None, t[0] or 0) for t in texts)
    at = 0
    for row in digests:
        assert row["start"] == at
        at += row["n_tokens"]
    for row in digests:
        if row["doc_id"] == 5:
            continue  # two documents of the same id, in any order
        ids = np.append(encoder(dict(texts)[row["doc_id"]] or ""), END_ID).astype("<u4")
        assert (row["n_tokens"], row["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))
    read = {r["doc_id"]: r["ids"] for r in token_files.read_tokens(spark, path).collect()}
    assert read[3] == [*encoder(dict(texts)[3]).tolist(), END_ID]


def test_common_ids_take_one_byte(spark, frame):
    path = written(spark, frame([(1, "the of and " * 5000 + "zygote")], "doc_id long, text string"))
    row = spark.read.parquet(path).first()
    assert len(row["data"]) == row["tokens"] and np.frombuffer(row["vocabulary"], "<u4").size < 10


def test_empty_table(spark, frame):
    path = written(spark, frame([], "doc_id long, text string"))
    assert token_files.token_digests(spark, path).collect() == []
