import importlib
import sys

import __spark_entry__
import corpus_pipeline
import public_tokenizers
import test_bpe
import test_decontam
import test_lines
import test_simhash
from helpers import clashing, words
from tokenizers import Tokenizer

from cohortframe.llm import lines, queries
from cohortframe.llm.util import connected_components, fresh

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    """Each stage on its predecessor's rows, held against the plain version of its method."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    table = lambda df: sorted((r["doc_id"], r["text"], r["source"]) for r in df.collect())
    step = dict(corpus_pipeline.STAGES)
    known = step["language"](spark, docs, SF)
    model = queries.language_model(docs)
    before = table(docs)
    low = model.predict([t for _, t, _ in before])[2]
    want = [r for r, gone in zip(before, low) if not gone]
    assert known.columns == docs.columns and table(known) == want and len(want) > 0.95 * len(before)
    cleaned = step["line_dedup"](spark, known, SF)
    texts = dict(test_lines.slow(want, lines.RATIO, lines.MIN_PAGES))
    want = [(i, texts[i], s) for i, _, s in want]
    assert cleaned.columns == docs.columns and table(cleaned) == sorted(want)
    single = step["simhash"](spark, cleaned, SF)
    comp = test_simhash.slow_components([r[0] for r in want], [test_simhash.slow_fingerprint(r[1]) for r in want])
    want = [r for r, c in zip(want, comp) if r[0] == c]
    assert single.columns == docs.columns and table(single) == sorted(want)
    safe = step["decontamination"](spark, single, SF)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {r[0] for r in test_decontam.slow([(i, t) for i, t, _ in want], items) if r[5]}
    want = [r for r in want if str(r[0]) not in hit]
    assert hit and safe.columns == docs.columns and table(safe) == sorted(want)
    library = Tokenizer.from_file(str(public_tokenizers.path(queries.VOCABULARY)))
    got = {r["doc_id"]: r["ids"] for r in step["bpe"](spark, safe, SF).collect()}
    assert got == {i: library.encode(t, add_special_tokens=False).ids for i, t, _ in want}


def test_run_and_registration(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "line_dedup", "simhash", "decontamination", "bpe"]
    names = __spark_entry__.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {x.split("_")[0] + "_" for x in names if x.startswith("op")} and "pipeline" in names
    assert set(queries.ORACLE) <= set(names)
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 100 and "ids_sha256" in rows.columns


def test_components_of_chains_stars_and_circles(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(900, 901), (901, 902), (902, 900)] + [(7, 7)]
    got = {r["u"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{i: 500 for i in range(501, 560)}, 901: 900, 902: 900}
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_fresh_names(spark):
    df = spark.createDataFrame([(1, 2)], "A int, _a int")
    assert fresh(df, "a", "b", "b") == ["__a", "b", "_b"]


def through(spark, docs):
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    return docs


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.isEmpty()
    assert through(spark, docs).isEmpty()


def test_stages_on_null_repeated_long_and_clashing_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    some = docs.select("doc_id", "text", "lang", "source", "n_chars")
    first = some.orderBy("doc_id").first()
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    long = "and the word that is of the house in " + " ".join(f"the and word{i % 7919} of that" for i in range(60_000))
    extra = [(9001, None, "en", "src0", None), (9002, "", "en", "src0", 0), (9003, "  ", None, None, 2), (None, "the and of that is a text by nobody and without any number", "en", "src0", None),
             (9004, long, None, "src1", None), (9005, "the and of that is " + item, None, None, None), (first["doc_id"], first["text"], first["lang"], first["source"], first["n_chars"])]
    both = clashing(some.unionByName(spark.createDataFrame(extra, some.schema)))
    step = dict(corpus_pipeline.STAGES)
    known = step["language"](spark, both, SF)
    ids = [r["doc_id"] for r in known.select("doc_id").collect()]
    assert known.columns == both.columns and not {9001, 9002, 9003} & set(ids) and ids.count(first["doc_id"]) == 2 and {9004, None} <= set(ids)
    cleaned = step["line_dedup"](spark, known, SF)
    assert cleaned.columns == both.columns and cleaned.count() == known.count()
    single = step["simhash"](spark, cleaned, SF)
    ids = [r["doc_id"] for r in single.select("doc_id").collect()]
    assert single.columns == both.columns and ids.count(first["doc_id"]) == 1 and {9004, None} <= set(ids)
    safe = step["decontamination"](spark, single, SF)
    ids = {r["doc_id"] for r in safe.select("doc_id").collect()}
    assert safe.columns == both.columns and 9005 not in ids and {9004, None} <= ids
    got = {r["doc_id"]: r["n_tokens"] for r in step["bpe"](spark, safe, SF).select("doc_id", "n_tokens").collect()}
    assert set(got) == ids and got[9004] > 200_000
