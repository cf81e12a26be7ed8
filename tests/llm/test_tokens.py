"""Packing and the chunk store against the tokenizer itself."""

import random
import unicodedata
import zlib
from math import ceil

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from graphloom.llm import chunk_store as K
from graphloom.llm import packing as P
from graphloom.llm import tokens
from graphloom.llm.queries import BYTE_VOCABULARY, WORD_VOCABULARY
from graphloom.llm.tokens import Encoder

ODD = [None, "", " ", "a", " a", "a  b", "\n", "\n\na", "a\n", "a \nb", "a\n b", "x\ty z", "it's 'll x'sy", "<|endoftext|> a", "Σας ΣΑΣ é ́", "A...Bé.é.", "x\x00y z.", ".", "\n.", " .a", "a  b", "日本 語。"]


def ids_of(name, text):
    return Tokenizer.from_file(public_tokenizers.path(name)).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", [WORD_VOCABULARY, BYTE_VOCABULARY])
def test_cuts_don_t_change_ids(name):
    rnd = random.Random(1)
    texts = ODD + ["".join(rnd.choice("abÉßİ ,.'\n1\t#\x01") for _ in range(rnd.randrange(60))) for _ in range(300)]
    texts += ["a<|startoftext|>b", "x <|ENDOFTEXT|> y", "<|endoftext|>", "PEKİ. BELEDİYESİ, ve", "a\u0958. \u0958b", "\x01", "a \x01 b"]
    # each letter and mark of Unicode: alone, before marks, after one
    signs = [chr(k) for k in range(0x110000) if unicodedata.category(chr(k))[0] in "LM"]
    texts += [" ".join(f"{x}. b{x},c {x}{x}'s" for x in signs[k : k + 200]) for k in range(0, len(signs), 200)]
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    for first, ids, at in Encoder(public_tokenizers.path(name)).slices(pa.array(texts, pa.string())):
        for k in range(len(at) - 1):
            assert ids[at[k] : at[k + 1]].tolist() == plain.encode(texts[first + k] or "", add_special_tokens=False).ids, texts[first + k]


@pytest.mark.parametrize("name", [WORD_VOCABULARY, BYTE_VOCABULARY])
def test_kept_cuts_give_way_and_words_go_together(name, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_CUTS", 40)
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abeétsßŁ") for _ in range(rnd.randrange(1, 12))) for _ in range(3_000)]
    words += ["x" * 70, "12,5", "d'été,"]
    texts = [" ".join(rnd.choices(words[: rnd.choice([20, 3_003])], k=50)) for _ in range(400)]
    encoder, sent = Encoder(public_tokenizers.path(name)), []

    class Counted:
        def __init__(self, model):
            self.tokenize, self.token_to_id = (lambda text: sent.append(text) or model.tokenize(text)), model.token_to_id

    encoder.model = Counted(encoder.model)
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    for first, ids, at in encoder.slices(pa.array(texts), 20_000):
        for k in range(len(at) - 1):
            assert ids[at[k] : at[k + 1]].tolist() == plain.encode(texts[first + k], add_special_tokens=False).ids
        assert len(encoder.cuts) <= 40 and len(encoder.ids) == encoder.size.sum()
    if name == BYTE_VOCABULARY:  # the other one marks the ends of words, so there they go one by one
        assert len(sent) < 200


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(2)
    texts = ODD + [" ".join(rnd.choice(["alpha", "beta", "gamma,", "Delta.", "eps"]) for _ in range(rnd.randrange(1, 3000))) for _ in range(60)]
    texts += [texts[-1]] * 3
    rows = [(k, t, 1, "k") for k, t in enumerate(texts)] + [(None, "no id", 1, "k"), (3, "a", 1, "k")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, piece int, _group string").repartition(3)


def test_packing(spark, docs):
    rows, df = docs
    got = P.pack(df, public_tokenizers.path(WORD_VOCABULARY), group_rows=40).collect()
    want = {}
    for i, t, *_ in rows:
        ids = [*ids_of(WORD_VOCABULARY, t), 0]
        for n, a in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[a : a + 2048], "<u4")
            want.setdefault((i, n, a, len(part), zlib.crc32(part.tobytes())), []).append(1)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=repr) == sorted((k for k, v in want.items() for _ in v), key=repr)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in got)
    assert len(bins) <= ceil(total / 2048) * 1.15 + 3
    streams = P.sequences(df, public_tokenizers.path(WORD_VOCABULARY)).collect()
    assert sum(len(r["ids"]) // 4 for r in streams) == total and all(len(r["ids"]) // 4 == r["n_tokens"] <= 2048 for r in streams)


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(score):
    rnd = random.Random(5)
    lengths = np.array(sorted((rnd.randrange(1, 101) for _ in range(2000)), reverse=True))
    capacity = (100, 3, 6000 if score == "dot" else 10_000)
    bins, offset = P.best_fit(lengths, capacity, (1.0, 0.1, 0.1), score) if capacity[2] == 10_000 else P.best_fit(lengths[lengths <= 77], capacity, (1.0, 0.1, 0.1), score)
    lengths = lengths[-len(bins) :]
    for b in set(bins.tolist()):
        own = lengths[bins == b]
        assert own.sum() <= capacity[0] and len(own) <= capacity[1] and (own**2).sum() <= capacity[2]
        assert sorted(offset[bins == b]) == [0, *np.cumsum(own[np.argsort(offset[bins == b])])[:-1]]
    # no two bins could be one, or best fit would have opened fewer: the last bin's first piece fitted no older one
    assert len(set(bins.tolist())) <= 2 * ceil(max(lengths.sum() / capacity[0], len(lengths) / capacity[1], (lengths**2).sum() / capacity[2])) + 1


def test_store_gives_back_every_stream(spark, docs, tmp_path):
    rows, df = docs
    K.write(df, public_tokenizers.path(BYTE_VOCABULARY), at := f"file://{tmp_path}/store", mean=64)
    got = sorted(K.read_back(spark, at).collect(), key=lambda r: r["start"])
    at_now = 0
    for r in got:
        assert r["start"] == at_now
        at_now += r["n_tokens"]
    assert [r["doc_id"] for r in got] == sorted((i for i, *_ in rows), key=lambda i: (i is not None, i))
    want = sorted(((i, len(x := np.array([*ids_of(BYTE_VOCABULARY, t), 0], "<u4")), zlib.crc32(x.tobytes())) for i, t, *_ in rows), key=repr)
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=repr) == want
    chunks, recipes, manifests = K.tables(spark, at)
    named = recipes.selectExpr("explode(transform(sequence(0, length(digests) div 16 - 1), k -> substring(digests, k * 16 + 1, 16))) as digest")
    assert chunks.count() == chunks.select("digest").distinct().count() == named.distinct().count() < named.count()
    assert manifests.count() == len(rows)
    names = {r["row"]: r["doc_id"] for r in manifests.collect()}
    whole = sorted(((names[r["row"]], zlib.crc32(np.frombuffer(bytes(r["ids"]), "<u2").astype("<u4").tobytes())) for r in K.reconstructed(spark, at).collect()), key=repr)
    assert whole == sorted(((i, c) for i, _, c in want), key=repr)
    # the files themselves are in order
    import glob

    import pyarrow.parquet as pq

    starts = [x for f in sorted(glob.glob(f"{tmp_path}/store/manifests/*.parquet")) for x in pq.read_table(f).column("start").to_pylist()]
    assert starts == [r["start"] for r in got]


def test_near_copies_and_passages_share_chunks(spark, tmp_path):
    """With the sizes as they are: a near copy adds little, and so does a passage within other texts."""
    rnd = random.Random(8)
    words = "the of river stone paper light under market winter seven garden letter music north bread window story".split()
    some = lambda n: [rnd.choice(words) + rnd.choice(["", "s", "ed", ","]) for _ in range(n)]
    base, passage = some(600), some(300)
    near = [" ".join([*base[:k], "edit", *base[k + 1 :]]) for k in (100, 300, 500)]
    held = [" ".join(some(60) + passage + some(60)) for _ in range(4)]
    for name, texts in (("near", near), ("held", held)):
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        K.write(df, public_tokenizers.path(BYTE_VOCABULARY), at := f"file://{tmp_path}/{name}")
        chunks, _, manifests = K.tables(spark, at)
        assert chunks.selectExpr("sum(length(ids))").first()[0] < 0.7 * manifests.selectExpr("sum(2 * n_tokens)").first()[0], name


def test_a_damaged_store_is_an_error(spark, docs, tmp_path):
    _, df = docs
    K.write(df.limit(20), public_tokenizers.path(BYTE_VOCABULARY), at := f"file://{tmp_path}/a")
    from pyspark.sql import functions as F

    manifests = spark.read.parquet(f"{at}/manifests")
    content = spark.read.parquet(f"{at}/content")
    swapped = F.concat(F.lit(b"\x01\x01"), F.expr("substring(body, 3)"))
    for name, bad, kept, message in [
        ("b", content.withColumn("body", F.when((F.col("kind") == "chunk") & (F.length("body") > 8), swapped).otherwise(F.col("body"))), manifests, "holds other ids"),
        ("c", content.where("kind = 'recipe' or n > 3"), manifests, "reconstruct"),
        ("d", content.withColumn("body", F.when((F.col("kind") == "recipe") & (F.length("body") > 16), swapped).otherwise(F.col("body"))), manifests, "reconstruct"),
        ("e", content, manifests.withColumn("n_tokens", F.col("n_tokens") + 1), "reconstruct"),
        ("f", content, manifests.withColumn("root", F.unhex(F.md5(F.hex("root")))), "reconstruct"),
    ]:
        bad.write.partitionBy("kind").parquet(f"file://{tmp_path}/{name}/content")
        kept.write.parquet(f"file://{tmp_path}/{name}/manifests")
        with pytest.raises(Exception, match=message):
            K.read_back(spark, f"file://{tmp_path}/{name}").collect()


def test_crc_and_cuts():
    rnd = random.Random(9)
    for _ in range(50):
        a, b = rnd.randbytes(rnd.randrange(50)), rnd.randbytes(rnd.randrange(5000))
        assert int(K.moved(np.array([zlib.crc32(a)]), np.array([len(b)]))[0]) ^ zlib.crc32(b) == zlib.crc32(a + b)
    for n in (1, 2, 63, 64, 65, 4096, 4097, 20_000):
        for marks in (np.array([], int), np.arange(n), np.array([n - 1])):
            ends = K.cuts(marks, n)
            sizes = np.diff([0, *ends])
            assert ends[-1] == n and (sizes > 0).all() and (sizes <= K.MOST).all() and (sizes[:-1] >= K.LEAST).all()


def test_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert P.pack(empty, public_tokenizers.path(WORD_VOCABULARY)).count() == 0
    assert K.digest(empty, public_tokenizers.path(BYTE_VOCABULARY)).count() == 0


@pytest.mark.parametrize("name", [WORD_VOCABULARY, BYTE_VOCABULARY])
def test_parts_of_a_column_have_their_own_ids(name):
    """A part's places in its bytes don't start at 0, nor do they once it is cast."""
    texts = ["Alpha. BETA", None, "gamma Delta,", "", "Éps 7"] * 4
    for column in (pa.array(texts)[7:], pa.array(texts).cast(pa.large_string())[7:], pa.array(texts)[7:].cast(pa.large_string())):
        for first, ids, at in Encoder(public_tokenizers.path(name)).slices(column):
            assert [ids[at[k] : at[k + 1]].tolist() for k in range(len(at) - 1)] == [ids_of(name, t) for t in texts[7 + first : 7 + first + len(at) - 1]]
