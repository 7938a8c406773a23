import random
from bisect import bisect_left
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pytest

from tests.llm.helpers import SF_DIR, WORD, clashing, document, documents, prose
from tidemark.llm.near_dedup import _differing, _overlapping, drop_near_duplicates, labelled_kmers, near_classes, parity_bits


def labelled(text):
    words = WORD.findall(text.lower())
    if not words:
        return []
    k = min(5, len(words))
    seen, out = Counter(), []
    for i in range(len(words) - k + 1):
        gram = tuple(words[i : i + k])
        out.append((gram, seen[gram]))
        seen[gram] += 1
    return out


def ordered_similarity(a, b):
    place = {x: i for i, x in enumerate(b)}
    ends = []
    for j in (place[x] for x in a if x in place):
        at = bisect_left(ends, j)
        ends[at : at + 1] = [j]
    return len(ends) / (len(a) + len(b) - len(ends))


def brute_classes(rows):
    """Least id per document, from all pairs of texts that share a k-mer."""
    texts = {i: labelled(t or "") for i, t in rows}
    root = {i: i for i in texts}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, grams in texts.items():
        for g in grams:
            holders[g].append(i)
    pairs = {(a, b) for own in holders.values() for a in own for b in own if a < b}
    for a, b in pairs:
        if min(len(texts[a]), len(texts[b])) >= 0.8 * max(len(texts[a]), len(texts[b])):
            if ordered_similarity(texts[a], texts[b]) >= 0.8:
                low, high = sorted((top(a), top(b)))
                root[high] = low
    return {i: top(i) for i in texts}


@pytest.mark.parametrize("sf", [SF_DIR.replace("0.001", "0.01")])
def test_classes_equal_brute_force(spark, sf):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    got = {r["doc_id"]: r["class_id"] for r in near_classes(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    assert got == brute_classes(rows)


def test_large_group_of_near_copies_and_a_shared_passage(spark):
    rng = random.Random(3)
    base = prose("base", 20).split()
    rows = []
    for i in range(150):  # each differs from the base in one word
        words = list(base)
        words[rng.randrange(len(words))] = f"edit{i}"
        rows.append((i, " ".join(words)))
    passage = prose("common", 8)
    rows += [(1000 + i, f"{prose(f'own{i}', 5)} {passage}") for i in range(150)]  # alike, not near copies
    rows += [(2000 + i, prose(f"pair{i // 2}", 5) + f" end{i}") for i in range(40)]
    got = near_classes(documents(spark, [document(*r) for r in rows])).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == brute_classes(rows)


def test_order_matters(spark):
    sentences = prose("x", 12).split(". ")
    turned = ". ".join(sentences[6:] + sentences[:6])
    got = near_classes(documents(spark, [document(1, ". ".join(sentences)), document(2, turned)])).collect()
    assert {r["class_id"] for r in got} == {1, 2}


def test_odd_rows(spark, odd):
    got = sorted(near_classes(clashing(odd)).collect(), key=str)
    assert len(got) == odd.count()
    classes = [(r["doc_id"], r["class_id"], r["class_size"]) for r in got]
    assert classes.count((1, 1, 3)) == 2 and (2, 1, 3) in classes
    assert (4, 4, 1) in classes and classes.count((None, None, 1)) == 2
    kept = drop_near_duplicates(clashing(odd))
    assert kept.columns == clashing(odd).columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids == [1, 3, 4, 5, 6, 7, 8, 8, 9]


def test_empty(empty):
    assert near_classes(empty).count() == 0
    assert drop_near_duplicates(empty).count() == 0


def crowd(pairs, seed=11):
    """Texts that share three quarters of their words and are not near copies, each with a twin that is one."""
    rng = random.Random(seed)
    shared = [f"s{i}" for i in range(300)]
    rows = []
    for i in range(pairs):
        own = [f"o{i}x{j}" for j in range(70)]
        twin = list(own)
        twin[rng.randrange(70)] = f"t{i}"
        rows += [(2 * i, " ".join(shared + own)), (2 * i + 1, " ".join(shared + twin + [f"e{i}x{j}" for j in range(20)]))]
    return rows


def test_twins_in_a_crowd_are_found(spark):
    rows = crowd(250)
    assert 0.8 <= ordered_similarity(labelled(rows[0][1]), labelled(rows[1][1])) < 0.95
    assert 0.6 < ordered_similarity(labelled(rows[0][1]), labelled(rows[2][1])) < 0.8
    got = {r["doc_id"]: r["class_id"] for r in near_classes(documents(spark, [document(*r) for r in rows])).collect()}
    assert all(got[i] in (i, i - i % 2) for i, _ in rows)  # no class holds texts of two pairs
    found = sum(got[2 * i + 1] == 2 * i for i in range(250)) / 250
    assert found >= 0.9


def test_exact_goes_on_until_all_that_meet_are_aligned(spark):
    rows = crowd(60, 5)
    got = near_classes(documents(spark, [document(*r) for r in rows]), exact=True).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == brute_classes(rows)


def test_nothing_large_that_is_written_is_left(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.iterdir()) if folder.exists() else set()
    near_classes(documents(spark, [document(*r) for r in crowd(20)])).count()
    left = {p.name.split("-")[1] for p in set(folder.iterdir()) - before}
    assert not left & {"texts", "sketches", "pairs", "links", "crowded"}


def test_no_twin_in_a_crowd_is_lost(spark):
    rows = crowd(60, 5)
    docs = documents(spark, [document(*r) for r in rows])
    few = ((8, 1),)  # most texts share the k-mer of lowest rank: crowded buckets, and no further level

    def classes(**how):
        return {r["doc_id"]: r["class_id"] for r in near_classes(docs, levels=few, **how).collect()}

    want = brute_classes(rows)
    assert classes(exact=False) != want
    assert classes() == want


def test_pairs_of_a_crowd_grow_with_its_links(spark):
    rows = crowd(150, 7)
    grams = {i: labelled(t) for i, t in rows}
    similar = {(2 * i, 2 * i + 1) for i in range(150)}
    assert all(ordered_similarity(grams[a], grams[b]) >= 0.8 for a, b in similar)
    texts = spark.createDataFrame(rows, "node bigint, text string")
    roots = spark.createDataFrame([], "node bigint, root bigint")
    pairs = {tuple(r) for r in _overlapping(texts, roots, 0.8, 5).collect()}
    assert similar <= pairs and len(pairs) <= 2 * len(rows)  # of 44,850 that share three quarters of their words


@pytest.mark.parametrize("least", [0.3, 0.8])
def test_no_similar_pair_is_lost_whatever_the_sizes(spark, least):
    rng = random.Random(2)
    words = prose("w", 60).split()
    rows = []
    for i in range(70):
        own = words[: rng.choice([12, 30, 34, 60, 66, 120, 140, 400])]
        for _ in range(rng.randrange(4)):
            own[rng.randrange(len(own))] = f"e{i}"
        rows.append((i, " ".join(own)))
    texts = spark.createDataFrame(rows, "node bigint, text string")
    roots = spark.createDataFrame([], "node bigint, root bigint")
    pairs = {tuple(r) for r in _overlapping(texts, roots, least, 5).collect()}
    grams = {i: labelled(t) for i, t in rows}
    similar = {(a, b) for a in grams for b in grams if a < b and ordered_similarity(grams[a], grams[b]) >= least}
    assert len({len(g) for g in grams.values()}) > 4 and similar and similar <= pairs


def test_bitmaps_differ_in_no_more_than_their_texts(spark):
    texts = {i: labelled_kmers(prose(f"t{i % 3}", 40)[: 120 * 2 ** (i // 3)]) for i in range(12)}
    bits = spark.createDataFrame([(i, parity_bits(x).tolist()) for i, x in texts.items()], "i int, bits array<bigint>")
    other = bits.selectExpr("i as j", "bits as more")
    assert bits.selectExpr("count(distinct size(bits))").first()[0] > 2
    for r in bits.crossJoin(other).select("i", "j", _differing("bits", "more").alias("n")).collect():
        only = len(set(texts[r["i"]].tolist()) ^ set(texts[r["j"]].tolist()))
        assert r["n"] <= only and (r["n"] > 0) == (only > 0)
