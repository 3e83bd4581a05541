"""Samples with a real vocabulary, against the tokenizers library applied row by row."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from sifter.operators import samples as S
from sifter.plans.catalog import QUERIES
from sifter.sources import adapters as A

from .conftest import SF001

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def library_ids(text):
    return tokenizers.Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def test_ids_of_odd_texts(spark, monkeypatch):
    texts = ["", None, "plain words", "héllo 漢字 😀\n\t", "a" * 5000, "<|endoftext|> 12,5", "", " x" * 40_000, None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    got = dict(df.select("i", S.vocabulary_encoder(PATH)("t")).collect())
    assert got == {i: None if t is None else library_ids(t) for i, t in enumerate(texts)}


def test_text_groups_keep_order_and_all_texts(monkeypatch):
    monkeypatch.setattr(S, "BATCH_CHARS", 10)
    texts = ["abc", "", "x" * 30, "abcdefgh", "ab", "c", ""]
    groups = list(S._text_groups(texts))
    assert [t for g in groups for t in g] == texts and max(len(g) for g in groups) > 1
    assert all(len(g) == 1 or sum(map(len, g)) <= 10 for g in groups) and list(S._text_groups([])) == []


def test_no_rows(spark):
    df = spark.createDataFrame([], "t string")
    assert df.select(S.vocabulary_encoder(PATH)("t")).collect() == []


def test_query_equals_row_by_row(spark):
    import hashlib

    rec = S.normalize(S.records_from_items(A.raw_records(spark, SF001)))
    rec = S.render_prompt(S.build_messages(rec)).filter(F.col("drop_reason").isNull()).select("pos", "prompt", "answer").collect()
    tok = tokenizers.Tokenizer.from_file(PATH)
    md5 = lambda ids: hashlib.md5(",".join(map(str, ids)).encode()).hexdigest()
    want = set()
    for r in rec:
        p, a = (tok.encode(t, add_special_tokens=False).ids for t in (r.prompt, r.answer))
        ids, labels = (p + a)[-S.MAX_LENGTH :], ([S.IGNORE_INDEX] * len(p) + a)[-S.MAX_LENGTH :]
        want.add((r.pos, len(ids), labels.count(S.IGNORE_INDEX), md5(ids), md5(labels)))
    got = QUERIES["t6_vocabulary_samples"](spark, SF001).collect()
    assert len(got) == len(rec) > 0 and {tuple(r) for r in got} == want


def test_ids_by_word_are_those_of_whole_texts():
    import random

    vocabulary, draw = S._vocabulary(PATH), random.Random(5)
    chars = ["a", "B", "é", "漢", "😀", "7", "½", "!", "'s", "'", "_", " ", "  ", "\n", "\t", "\r", "\x0b", "\x00", "\x1c", "\x1f", "\x85", "\xa0", "\u200b", "\u2028", "\u3000", "<|endoftext|>", "\u0301"]
    texts = ["".join(draw.choices(chars, k=draw.randrange(30))) for _ in range(5000)] + ["", " ", "\n\n", "a" * 300 + " a", "a\t  b"]
    assert vocabulary.by_word
    want = [e.ids for e in vocabulary.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, np.int32).tolist() for b in vocabulary(texts)] == want
    assert [np.frombuffer(b, np.int32).tolist() for b in vocabulary(texts)] == want  # from what is kept
    assert max(map(len, vocabulary.kept)) <= S.LONG_WORD


@pytest.mark.parametrize("name", ["prefix", "normalizer", "token"])
def test_other_tokenizers_get_whole_texts(name):
    t = tokenizers.Tokenizer.from_file(PATH)
    if name == "prefix":
        t.pre_tokenizer = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=True)
    elif name == "normalizer":
        t.normalizer = tokenizers.normalizers.Replace("a b", "c")
    else:
        t.add_tokens(["a b"])
    vocabulary, texts = S._Vocabulary(t), ["a b c", "x a b", "", "one  two"]
    assert not vocabulary.by_word
    assert [np.frombuffer(b, np.int32).tolist() for b in vocabulary(texts)] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_a_word_goes_to_the_tokenizer_once():
    asked = []

    class Counting(S._Vocabulary):
        def _whole(self, texts):
            asked.extend(texts)
            return super()._whole(texts)

    vocabulary = Counting(tokenizers.Tokenizer.from_file(PATH))
    for _ in range(3):
        vocabulary(["some words and some words", " some more"] * 4)
    assert sorted(asked) == [" and", " more", " some", " words", "some"]


def test_records_of_one_file_are_dealt_to_all_tasks(spark, monkeypatch):
    rows = A.raw_records(spark, SF001).count()
    monkeypatch.setattr(A, "SPREAD_ROWS", rows // 40)
    spread = A.raw_records(spark, SF001, spread=True)
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert A.raw_records(spark, SF001).rdd.getNumPartitions() < 40 <= len(sizes)
    assert sum(sizes) == rows and max(sizes) <= rows // 40 + len(sizes)
