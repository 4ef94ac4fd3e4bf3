"""The pipeline, stage by stage, against plain restatements of each stage's decisions."""

import hashlib
from collections import Counter

import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from runlens.llm import byte_bpe, language_id, quality_classifier, queries
from runlens.llm.common import stored

from .helpers import DATA, docs, mixed, roots, simhash, write

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in df.collect()]


def test_stages_against_plain_decisions(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_copies", "mix", "tokens"]
    table = spark.read.parquet(f"{DATA}/documents.parquet")
    before, outputs = table, {}
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, before, DATA), "t")
        outputs[name] = (rows_of(before), after)
        before = after
    inputs = {name: rows for name, (rows, _) in outputs.items()}

    model = queries.quality_model(table, spark.read.parquet(f"{DATA}/labels.parquet"))
    terms = [quality_classifier.term_counts(r[1].encode()) for r in inputs["quality"]]
    score = [model.scores(t[None, :].astype(float), quality_classifier.np.array([float(len(r[1].encode()))]))[0]
             for t, r in zip(terms, inputs["quality"], strict=True)]
    good = [r for r, s in zip(inputs["quality"], score, strict=True) if s >= 0.3]
    assert 0 < len(good) < len(inputs["quality"]) and Counter(good) == Counter(inputs["language"])

    model = queries.language_model(spark.createDataFrame(inputs["language"], table.schema))
    spanned = lambda t: model.spanned(model.landmarks.kernels([t])[0])[0]
    told = [r for r in good if any(c.isalpha() for c in r[1]) and (len(r[1]) < 300 or spanned(r[1]) >= model.floor)]
    assert Counter(inputs["near_copies"]) == Counter(told) and 0 < model.floor < 1

    prints = [simhash(r[1], 3) for r in inputs["near_copies"]]
    root = roots(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    first = {}
    for r, row in zip(root, inputs["near_copies"], strict=True):
        first[r] = min(first.get(r, row), row)
    assert Counter(first.values()) == Counter(inputs["mix"]) and len(first) < len(prints)

    taken, _ = mixed([(r[0], r[1], r[3]) for r in inputs["mix"]], **queries.MIX)
    times = Counter({r: t // len(r[1].encode().split()) for r, t in zip(inputs["mix"], taken, strict=True) if t})
    assert times == Counter(inputs["tokens"])

    last = outputs["tokens"][1]
    assert last.columns == [*COLUMNS, "n_tokens", "ids_sha256", "decoded_sha256"]
    plain = tiktoken.Encoding("plain", pat_str=queries.PATTERN, mergeable_ranks=byte_bpe.read_ranks(queries.RANKS),
                              special_tokens={})
    for r in last.collect():
        ids = plain.encode_ordinary(r["text"])
        assert r["n_tokens"] == len(ids) and r["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert Counter(rows_of(corpus_pipeline.run(spark, DATA))) == Counter(rows_of(last))


def test_language_stage_drops_texts_of_no_learned_language(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    foreign = ["Дождь идёт весь день, и река поднимается. " * 20, "これは日本語で書かれた長い文章です。" * 30, "zqxw vjkq xzzw qvvx jjqz " * 30]
    short = ["Дождь идёт", "zqxw vjkq"]
    odd = docs(spark, foreign + short, ids=range(900_001, 900_006)).withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.language(spark, table.unionByName(odd), DATA)
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert not ids & {900_001, 900_002, 900_003} and {900_004, 900_005} <= ids  # short ones say too little
    lettered = {r["doc_id"] for r in table.collect() if any(c.isalpha() for c in r["text"])}
    assert ids - {900_004, 900_005} == lettered  # no document of a learned language goes


def test_extra_columns_clash_with_nothing(spark):
    names = ["row", "quality", "language", "tokens", "text_key", "id_key", "key", "size", "hash", "times", "doc", "_quality", "_found", "_tokens"]
    table = spark.read.parquet(f"{DATA}/documents.parquet").limit(150)
    table = table.select("*", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, table, DATA)
        assert found.columns == table.columns, name
        assert all(r[n] == f"{n}{r['doc_id']}" for r in found.collect() for n in names), name
    last = corpus_pipeline.tokens(spark, table, DATA)
    assert all(r[n] == f"{n}{r['doc_id']}" for r in last.collect() for n in names)


@pytest.mark.parametrize("texts", [[], [None, "", "12 34", None], ["a b c", "a b c", None, "x " * 100_000]])
def test_odd_tables(spark, scratch, texts):
    table = docs(spark, texts).selectExpr("*", "'extra' AS score", "doc_id AS size")
    write(table, scratch, "documents")
    write(spark.createDataFrame([], "doc_id long, quality int, toxic int"), scratch, "labels")
    found = corpus_pipeline.run(spark, scratch).collect()
    assert all(language_id.spectrum(r["text"], quality_classifier.np.zeros(language_id.DIMS)) for r in found)
    assert all(r["score"] == "extra" and r["size"] == r["doc_id"] for r in found)
    if texts == []:
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, table, scratch).columns == table.columns, name
