"""The pipeline stage by stage on odd tables, the mix as a corpus, and lines that go."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import SF_DIR, WORD, clashing, document, documents, prose
from tidemark.llm import mixing, quality


def test_mixed_texts_have_the_words_that_are_taken(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    want = {r["doc_id"]: r["taken"] for r in mixing.mix_sources(docs).collect() if r["taken"]}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = mixing.mix_corpus(docs).collect()
    assert {r["doc_id"]: r["taken"] for r in got} == want
    for r in got:
        words = WORD.findall(texts[r["doc_id"]])
        assert WORD.findall(r["text"]) == (words * 3)[: r["taken"]]
        assert r["text"].startswith(texts[r["doc_id"]]) or texts[r["doc_id"]].startswith(r["text"])


def test_equal_rows_are_taken_together(spark):
    rows = [document(1, prose("a", 2), source="s")] * 3 + [document(2, prose("b", 2), source=None), document(3, None), document(None, prose("c", 1))]
    got = mixing.mix_corpus(clashing(documents(spark, rows))).collect()
    words = Counter()
    for r in mixing.mix_sources(documents(spark, rows)).collect():
        words[r["doc_id"]] += r["taken"]
    assert {r["doc_id"]: r["taken"] for r in got} == {i: n for i, n in words.items() if n}
    assert all(len(WORD.findall(r["text"])) == r["taken"] for r in got)


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_bear_odd_and_empty_tables(spark, odd, empty, stage):
    name, run = stage
    labelled = documents(spark, [document(100 + i, prose(f"l{i}", 3), lang="en") for i in range(60)])
    wide = clashing(odd.union(labelled))
    out = run(spark, wide, SF_DIR)
    plain = run(spark, odd.union(labelled), SF_DIR)
    extra = ["taken"] if name == "source_mixing" else []
    assert out.columns == wide.columns + extra
    assert sorted(map(str, out.select(plain.columns).collect())) == sorted(map(str, plain.collect()))
    assert run(spark, empty, SF_DIR).count() == 0
    ids = Counter(r["doc_id"] for r in plain.collect())
    if name in ("decontamination", "personal_data"):
        assert sum(ids.values()) == odd.count() + 60
    if name == "near_dedup":
        assert ids[1] == 1 and ids[2] == 0 and ids[3] == 1


def test_lines_of_many_documents_go(spark):
    rows = [document(i, f"Own line {prose(f'x{i}', 1)}\n  Call NOW 0{i % 10}\nlast {'a' * i}", source="h") for i in range(12)]
    rows += [document(50 + i, "Call now 00\nother", source="g") for i in range(3)] + [document(60, None, source="h"), document(61, "", source="h"), document(None, "call now 77\n\nx", source="h")]
    docs = documents(spark, rows + rows[:1])
    got = quality.remove_frequent_lines(clashing(docs).drop("host"), "source", 10)
    texts = defaultdict(list)
    for r in got.collect():
        texts[r["doc_id"]].append(r["text"])
    assert len(texts[0]) == 2 and got.count() == len(rows) + 1
    for i, text, *_ in rows:
        want = text if text is None or (i or 0) >= 50 else re.sub(r"(?im)^\s*call now \d+\n", "", text)
        assert texts[i][0] == want
    assert quality.remove_frequent_lines(docs.limit(0)).count() == 0


def test_no_repeats_among_different_words_where_little_is_left_of_the_hash(spark):
    words = F.transform(F.sequence(F.lit(1), F.lit(60_000)), lambda i: F.hex(i))
    text = spark.range(1).select(F.lit(1).cast("long").alias("doc_id"), F.array_join(words, " ").alias("text"))
    twice = text.withColumn("text", F.concat("text", F.lit(" x 1 2 3")))
    for bits in (0, 40):  # of 60,000 runs about 100 share the 24 bits that 40 bits of place leave
        row = quality.text_statistics(text, bits).drop("text").first()
        assert row["n_words"] == 60_000 and row["n_repeat_words"] == 0
        assert quality.text_statistics(twice, bits).drop("text").first()["n_repeat_words"] == 6
