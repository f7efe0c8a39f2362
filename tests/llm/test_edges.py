"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyloom.llm import classifier, common, fingerprint, html_text, jaccard, mixing, packing, sharding, tool_calls, url_filter, weak_rules

# names that the operators use inside, as columns of the user's
CLASHES = "size int, key string, node long, label string, score double, bucket int, rank int, one int, shard int, slot int, copies int, words int, part int, before int, text_crc32 long, `_key` int, class_id string, n_words long"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHES
LONG = " ".join(f"word{k} goes on" for k in range(40_000))
PROSE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"


def doc(ident, text, source="a"):
    return (ident, text, "en", source, None, 1, "k", 5, "l", 0.5, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, "c", 1)


ROWS = [doc(1, PROSE), doc(2, ""), doc(2, ""), doc(3, LONG, "b"), doc(4, "x"), doc(5, PROSE, None), doc(None, None, None), doc(None, PROSE, "b"),
        doc(6, " \t\n "), doc(7, "é ü 漢字 😀 " * 30), doc(7, "another text of the same id", "b"), doc(8, "a a a a a a a a a a a a a a a a"), doc(8, "a a a a a a a a a a a a a a a a")]
LABELS = "doc_id long, quality int, toxic int, size int, key string, good int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def test_mix(docs, nothing):
    got = mixing.mix_rows(docs).collect()
    assert len(got) == len(ROWS)
    assert all(r["taken"] <= 3 * r["size"] and r["taken"] % max(1, r["size"]) == 0 for r in got)
    assert {r["source"] for r in got} == {"a", "b", None}
    assert all(r["size"] == 0 for r in got if r["doc_id"] in (2, 6))
    targets = {r["source"]: r["target"] for r in got}
    assert sum(targets.values()) == pytest.approx(sum(r["size"] for r in got))
    assert mixing.mix_rows(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0
    kept = mixing.mixed_documents(docs)
    assert kept.columns == docs.columns
    assert kept.where("doc_id = 2").count() == 2  # without words: kept once each


def test_shards(docs, nothing):
    got = sharding.shard_rows(docs, shards=4).collect()
    assert sorted(len([r for r in got if r["shard"] == s]) for s in range(4)) == [3, 3, 3, 4]
    for s in range(4):
        own = sorted(r["slot"] for r in got if r["shard"] == s)
        assert own == list(range(len(own)))
    assert all(r["size"] == 1 and r["text_crc32"] == 0 for r in got if r["doc_id"] == 2)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, sharding.shard_rows(docs.repartition(5), shards=4).collect()), key=repr)
    assert sharding.shard_rows(nothing).count() == 0


def test_pack(docs, nothing):
    got = packing.pack(docs, buckets=3, token_budget=100).collect()
    assert len(got) == len(ROWS)
    assert all(r["padding"] == r["bucket_len"] - r["n_tokens"] >= 0 for r in got)
    places = [(r["bucket"], r["batch"], r["place"]) for r in got]
    assert len(set(places)) == len(places)
    for b, n in {(r["bucket"], r["batch"]): r["bucket_len"] for r in got}.items():
        assert len([p for p in places if p[:2] == b]) * n <= 100 or len([p for p in places if p[:2] == b]) == 1
    assert packing.pack(nothing).count() == 0


def test_rules(docs, nothing):
    got = weak_rules.judged(docs).collect()
    assert len(got) == len(ROWS)
    assert all(r["base_failed"] and not r["kept"] and r["n_words"] == 0 for r in got if r["doc_id"] in (2, 6))
    assert [r["n_repeat_words"] for r in got if r["doc_id"] == 8] == [16, 16]
    assert next(r["n_words"] for r in got if r["doc_id"] == 3) == 120_000
    assert weak_rules.keep_good(docs).columns == docs.columns
    assert weak_rules.judged(nothing).count() == 0 and weak_rules.keep_good(nothing).count() == 0


def test_classifier(spark, docs, nothing):
    labels = spark.createDataFrame([(k, k % 2, None, 1, "k", 0) for k in range(9)] + [(None, 1, 0, 1, "k", 0), (3, None, 1, 1, "k", 1)], LABELS)
    no_labels = spark.createDataFrame([], LABELS)
    for known in (labels, no_labels):
        got = classifier.scored(docs, known).collect()
        assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
        assert len({r["score"] for r in got if r["doc_id"] in (2, 6)}) == 1
    assert classifier.scored(nothing, labels).count() == 0
    assert classifier.keep_good(docs, labels).columns == docs.columns


def test_jaccard(docs, nothing):
    got = jaccard.near_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    prose = [r for r in got if r["copies"] == 3 and r["class_id"] == 1]
    assert sorted((r["doc_id"] or 0) for r in prose) == [0, 1, 5] and all(r["n_links"] == 2 for r in prose)
    empties = [r for r in got if r["doc_id"] == 2]
    assert all(r["copies"] == 3 and r["n_links"] == 2 and r["class_id"] == 2 for r in empties)  # the null text counts as empty
    assert all(r["class_id"] == 6 and r["n_links"] == 0 for r in got if r["doc_id"] == 6)
    assert jaccard.near_duplicates(nothing).count() == 0 and jaccard.keep_one(nothing).count() == 0
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted({(r[0], r[1]) for r in ROWS if r[0] in (1, 2, 3, 4, 6, 7, 8)})


def test_fingerprints(docs, nothing, spark):
    got = fingerprint.fingerprints(docs).collect()
    assert len(got) == len(ROWS)
    assert len({r["fingerprint"] for r in got if r["n_chars"] == 0}) == 1
    assert len({r["fingerprint"] for r in got if r["n_chars"] == len(PROSE)}) == 1
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert fingerprint.fingerprints(nothing).count() == 0
    alone = fingerprint.fingerprints(spark.createDataFrame([doc(1, PROSE)], DOCS)).first()
    assert alone["near_next"] == 1.0


PAGES = "page_id long, url string, html string, host string, path string, row string, gone int, text string, template string"


def page(ident, url, html):
    return (ident, url, html, "h", "p", "r", 1, "t", "t")


def test_batches_are_bounded_by_bytes(spark):
    """Many long texts are many batches, in map functions and in Pandas UDFs alike."""
    common.bounded_batches(spark)
    long = spark.range(0, 60, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes], type=pa.int64())})

    @F.pandas_udf("long")
    def rows_at_once(texts: pd.Series) -> pd.Series:
        return pd.Series([len(texts)] * len(texts))

    seen = [r["n"] for r in long.mapInArrow(sizes, "n long").collect()]
    assert len(seen) >= 3 and max(seen) < 2 * common.BATCH_BYTES
    assert long.select(rows_at_once("text").alias("n")).agg(F.max("n")).first()[0] <= 32


def test_fingerprints_of_rows_alike_are_spread(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 2000, 7).otherwise(F.col("id")).alias("doc_id"),
                                    F.when(F.col("id") < 2000, F.lit(PROSE)).otherwise(F.concat_ws(" ", F.lit(PROSE), "id")).alias("text"))
    coalesce, shuffled = "spark.sql.adaptive.coalescePartitions.enabled", spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(coalesce, "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        tasks = fingerprint.in_order(rows, "doc_id", "text").groupBy(F.spark_partition_id()).count().collect()
        got = fingerprint.fingerprints(rows).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffled)
        spark.conf.unset(coalesce)
    assert max(r["count"] for r in tasks) < 1000 and sum(r["count"] for r in tasks) == 3000
    alike = [r for r in got if r["doc_id"] == 7]
    assert len(got) == 3000 and len(alike) == 2000 and len({r["fingerprint"] for r in alike}) == 1
    assert sum(r["near_next"] == 1.0 for r in alike) >= 1999  # the last one's next is another text


def test_pages(spark):
    pages = spark.createDataFrame([page(1, None, None), page(2, "no address", ""), page(3, "http://A.Org:80", "<p>x"), page(3, "http://A.Org:80", "<p>x"),
                                   page(None, "http://b.net/a/1?q", "<article>" + "<p>line</p>" * 30_000), page(5, "://", "<")], PAGES)
    nothing = spark.createDataFrame([], PAGES)
    labels = spark.createDataFrame([(1, 0, None), (None, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    got = url_filter.filter_urls(pages, url_filter.document_labels(labels)).collect()
    assert len(got) == 6
    assert [(r["host"], r["path"], r["rule"]) for r in got if r["page_id"] == 3] == [("a.org:80", "", None)] * 2
    assert all(r["host"] == "" and r["path"] == "" for r in got if r["page_id"] in (1, 2, 5))
    assert url_filter.filter_urls(nothing, url_filter.document_labels(labels)).count() == 0
    assert url_filter.filter_urls(pages, url_filter.document_labels(labels.limit(0))).where("verdict = 'allow'").count() == 6
    texts = {(r["page_id"], r["url"]): r["text"] for r in html_text.main_texts(pages).collect()}
    assert texts[(1, None)] == "" and texts[(3, "http://A.Org:80")] == "x" and texts[(None, "http://b.net/a/1?q")].count("line") == 30_000
    assert html_text.main_texts(pages).count() == 6 and html_text.main_texts(nothing).count() == 0


CHAT = "conv_id long, turn long, role string, text string, key string, kind string, level int"


def test_calls(spark):
    rows = [(1, 0, "user", "hello"), (1, None, None, None), (None, 1, "tool", '{"tool_call_id": "a", "content": 1}'), (1, 1, "tool", ""),
            (1, 2, "assistant", "{broken"), (1, 2, "assistant", "{broken"), (1, 3, "assistant", '{"tool_calls": [{"id": null}, 5]}'), (1, 4, "tool", "x" * 300_000)]
    got = tool_calls.linked(spark.createDataFrame([(*r, "k", "m", 1) for r in rows], CHAT), {}).collect()
    assert len(got) == 9
    assert sorted((r["kind"], r["status"] or "") for r in got).count(("call", "invalid")) == 2
    assert next(r["status"] for r in got if r["kind"] == "result") == "orphan"
    assert tool_calls.linked(spark.createDataFrame([], CHAT), {}).count() == 0


def test_pipeline(spark, docs, nothing, tmp_path):
    labels = spark.createDataFrame([(k, k % 2, None, 1, "k", 0) for k in range(9)], LABELS)
    for name, table in (("full", docs), ("none", nothing)):
        table.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        held = table
        for k, (stage, run) in enumerate(corpus_pipeline.STAGES):
            run(spark, held, f"{tmp_path}/{name}").write.parquet(f"{tmp_path}/{name}-{k}")
            held = spark.read.parquet(f"{tmp_path}/{name}-{k}")
            assert stage == "pack" or held.columns == docs.columns
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
