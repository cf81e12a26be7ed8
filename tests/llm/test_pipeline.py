"""The pipeline against plain Python, stage by stage, and its defined results for odd rows."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as C
from graphloom.llm import mixing, quality

from .conftest import jaccard_links, least_reachable, shingle_set
from .test_secret_scan import spans


@pytest.fixture(scope="module")
def folder(spark, data, tmp_path_factory):
    """The documents with odd rows and columns with names that operators use."""
    at = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{data}/documents.parquet")
    long_text = " ".join(f"word{k % 700} river{k % 311}" for k in range(6000))
    odd = [(9001, None, "en", "src1", None), (9002, "", None, None, 0), (9003, "tiny", "en", None, 4), (9004, long_text, "en", None, 5), (9004, long_text, "en", None, 5), (9005, long_text + " end", "en", "src2", 5), (None, None, None, None, None)]
    all_ = docs.unionByName(spark.createDataFrame(odd, docs.schema)).selectExpr("*", "1 as spans", "'x' as copies", "2 as size", "3 as _row", "4 as piece")
    all_.write.parquet(f"{at}/documents.parquet")
    spark.read.parquet(f"{data}/labels.parquet").write.parquet(f"{at}/labels.parquet")
    return at


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = C.quality_rules(spark, docs, folder).cache()
    good = {r["doc_id"] for r in quality.judged(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect() if r["kept"]}
    assert kept.columns == columns and {r["doc_id"] for r in kept.collect()} == good and 9003 not in good and None not in good

    one = C.ngram_jaccard_join(spark, kept, folder).cache()
    sets = {r["doc_id"]: shingle_set(r["text"]) for r in kept.collect()}
    root = least_reachable(sets, jaccard_links(sets))
    assert one.columns == columns and sorted(r["doc_id"] for r in one.collect()) == sorted(i for i in root if root[i] == i)

    clean = C.secret_scans(spark, one, folder).cache()
    before = {r["doc_id"]: r for r in one.collect()}
    assert clean.columns == columns and clean.count() == one.count()
    for r in clean.collect():
        t, at, out = before[r["doc_id"]]["text"], 0, ""
        for a, _, b in spans(t):
            if a >= at:
                out += t[at:a] + "[SECRET]"
            at = max(at, b)
        assert r["text"] == out + t[at:]
        assert r["n_chars"] == (len(r["text"]) if spans(t) else before[r["doc_id"]]["n_chars"])

    mixed = C.source_mixing(spark, clean, folder).cache()
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(clean).collect()}
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert mixed.columns == columns and counts == {k: v for k, v in copies.items() if v}

    packed = C.best_fit_packing(spark, mixed, folder).collect()
    t = Tokenizer.from_file(public_tokenizers.path(C.VOCABULARY))
    want = []
    for r in mixed.collect():
        ids = np.array([*t.encode(r["text"], add_special_tokens=False).ids, 0], "<u4")
        want += [(r["doc_id"], n, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for n, a in enumerate(range(0, len(ids), 2048))]
    assert sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in packed) == sorted(want)


def test_rows_without_id_go_by_their_own_text(spark, folder):
    """One that the rules keep and one that they reject; then one that equals a text with an id and one that doesn't."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = C.quality_rules(spark, docs, folder)
    first, second = (r["text"] for r in kept.where("doc_id is not null").orderBy("doc_id").limit(2).collect())
    own = lambda *texts: spark.createDataFrame([(None, t, "en", "s", 1) for t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    both = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(own(first, "tiny", None, ""))
    assert [r["text"] for r in C.quality_rules(spark, both, folder).where("doc_id is null").collect()] == [first]
    some = own(first, second).unionByName(kept.where(F.col("text") == first).select("doc_id", "text", "lang", "source", "n_chars"))
    assert [r["text"] for r in C.ngram_jaccard_join(spark, some, folder).where("doc_id is null").collect()] == [second]


def test_run_applies_the_stages(spark, folder):
    assert [k for k, _ in C.STAGES] == ["quality_rules", "ngram_jaccard_join", "secret_scans", "source_mixing", "best_fit_packing"]
    assert C.run(spark, folder).count() > 0


def test_empty(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        out = stage(spark, docs, folder)
        assert out.count() == 0
        docs = out if "text" in out.columns else docs
