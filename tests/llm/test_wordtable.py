import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from monthmill.llm import wordtable

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    (1, None), (2, ""), (3, " \t\n\x0b\f\r"), (4, "Hello wörld<|endoftext|>x it's ok 'S 12"),
    (5, "a b c\x85d\x1ce  f"), (6, "é ́x Å İstanbul ΣΑΣ ﬁ"), (None, "null key"), (7, "same text"), (7, "same text"),
    (8, "<|startoftext|><|endoftext|> <|endoftext|>"), (9, "\U0001f600‍ 漢字 кириллица \x00 |||| 3.14,15"),
    (10, "x" * 3000), (11, "word. word, Word; wORD!? word"), (12, "it 's we 're"), (-3, "  lead and trail  "),
]


@pytest.fixture(scope="module")
def model():
    found = Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


def expected(model, rows):
    out = []
    for key, text in rows:
        ids = model.encode(text or "", add_special_tokens=False).ids
        decoded = model.decode(ids, skip_special_tokens=False).encode()
        raw = np.asarray(ids, "<u4").tobytes()
        out.append((key, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [16_000_000, 40])
def test_ids_and_texts_equal_the_library(spark, space, texts, model, block):
    rows = ODD + [(100 + k, f"the hot word {k % 5} the the") for k in range(60)]
    found = wordtable.digests(texts(*rows), PATH, space, block_bytes=block).collect()
    assert sorted(map(tuple, found), key=str) == expected(model, rows)


def test_given_documents_and_a_very_long_one(spark, space, given, model):
    docs = given("documents").select("doc_id", "text")
    long = docs.filter("text is not null").agg(F.concat_ws(" ", F.collect_list("text")).alias("text"))
    docs = space.write(docs.unionByName(long.select(F.lit(-1).cast("bigint").alias("doc_id"), "text")), "docs")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert max(len(text or "") for _, text in rows) > 300_000
    found = wordtable.digests(docs, PATH, space, block_bytes=100_000).collect()
    assert sorted(map(tuple, found), key=str) == expected(model, rows)


def test_a_bucket_encodes_each_distinct_word_once(monkeypatch):
    """However many blocks list a word, it reaches the library once."""
    rows = pa.RecordBatch.from_pydict({"k": list(range(50)), "t": [f"alpha beta gamma{k % 7} alpha" for k in range(50)]})
    cut = [wordtable.Block(texts, 3) for _, texts in wordtable.blocks(iter([rows]), 60)]
    entries = [(b.name(k), bucket, words) for k, b in enumerate(cut) for bucket, words in b.lists.items()]
    spoken = []
    real = wordtable.encoder(PATH)

    class Logged:
        known, words = real.known, real.words

        def encode(self, words):
            spoken.extend(words)
            return real.encode(words)

    monkeypatch.setattr(wordtable, "encoder", lambda path: Logged())
    for bucket in range(3):
        of_bucket = [e for e in entries if e[1] == bucket]
        table = pa.table(dict(zip(("block", "bucket", "words"), map(list, zip(*of_bucket, strict=True)), strict=True)))
        found = wordtable.encoded_bucket(table, PATH)
        assert found.num_rows == len(of_bucket)
    assert len(cut) > 10 and len(entries) > 20
    assert sorted(spoken) == sorted({"alpha", "beta", *(f"gamma{k}" for k in range(7))})


def test_other_keys_empty_tables_and_clashing_columns(spark, space, model):
    rows = [("a", "x y"), ("b", None), (None, "z")]
    docs = spark.createDataFrame([(k, t, 1, 2, 3) for k, t in rows], "`my.id` string, body string, ids int, block int, `a.b` int")
    found = wordtable.encode(docs, PATH, space, key="my.id", text="body")
    assert found.columns == ["my.id", "ids"]
    got = {r[0]: np.frombuffer(r[1], "<u4").tolist() for r in found.collect()}
    assert got == {k: model.encode(t or "", add_special_tokens=False).ids for k, t in rows}
    assert wordtable.encode(docs.limit(0), PATH, space, key="my.id", text="body").count() == 0
    assert wordtable.digests(docs.selectExpr("1 as doc_id", "body as text").limit(0), PATH, space).count() == 0


def test_decoding_unknown_ids_nulls_and_another_tokenizer(spark, model):
    ids = [np.asarray(x, "<u4").tobytes() for x in ([3306, 999_999, 86], [], [49407])]
    df = spark.createDataFrame([(k, x) for k, x in enumerate([*ids, None])], "n int, ids binary")
    assert [r.decoded for r in wordtable.decode(df, PATH).orderBy("n").collect()] == ["hello</w> w", "", "<|endoftext|>", None]
    other = public_tokenizers.path("byte_bpe_50k.json")
    texts = Tokenizer.from_file(other)
    raw = np.asarray(texts.encode("Größe  of a tree\n").ids, "<u4").tobytes()
    one = spark.createDataFrame([(raw,)], "ids binary")
    assert wordtable.decode(one, other).first().decoded == "Größe  of a tree\n"
    with pytest.raises(ValueError, match="white space"):
        wordtable.check_tokenizer(other)
