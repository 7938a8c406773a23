import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SF_DIR, WORD, clashing, document, documents, prose
from tidemark.llm import decontamination, language, licenses, mixing, privacy, quality, scoring, substrings, urls
from tidemark.llm.queries import QUERIES, SQL
from tools.check_queries import sorted_rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def texts():
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF_DIR}/documents.parquet'").fetchall()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "pages", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    cursor = db.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    df = QUERIES[name](spark, SF_DIR)
    assert sorted(names) == sorted(df.columns)
    assert sorted_rows(df.columns, [tuple(r) for r in df.collect()]) == sorted_rows(names, cursor.fetchall())


# ------------------------------------------------------------------ odd and empty tables


def _operators(spark):
    items = spark.createDataFrame([(1, prose("a", 3)), (2, None), (None, "x"), (3, ""), (4, "One.")], "item_id bigint, text string")
    return {
        "substrings": substrings.remove_repeats,
        "mixing": mixing.mix_sources,
        "language": language.identify_languages,
        "contamination": lambda d: decontamination.find_contamination(d, items),
        "quality": quality.quality_rules,
        "privacy": privacy.find_personal_data,
        "licenses": lambda d: licenses.scan_licenses(d, licenses.known_notices(spark)),
        "scoring": lambda d: scoring.score_documents(d, d),
    }


ROWS = {"substrings": None, "licenses": None, "contamination": None}


@pytest.mark.parametrize("name", ["substrings", "mixing", "language", "contamination", "quality", "privacy", "licenses", "scoring"])
def test_odd_and_empty(spark, odd, empty, name):
    operator = _operators(spark)[name]
    got = operator(clashing(odd)).collect()
    plain = operator(odd).collect()
    assert sorted(map(str, got)) == sorted(map(str, plain))
    if name not in ROWS:
        assert len(got) == odd.count()
    if name == "substrings":
        assert [r["doc_id"] for r in got] == [2]
    if name == "contamination":
        assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 1), (1, 1), (2, 1), (8, 4)]
    if name == "privacy":
        assert all(r["spans"] == "" for r in got)
    assert operator(empty).count() == 0


def test_filters_keep_columns(odd, spark):
    items = spark.createDataFrame([(1, prose("a", 3))], "item_id bigint, text string")
    wide = clashing(odd)
    assert decontamination.drop_contaminated(wide, items).columns == wide.columns
    assert decontamination.drop_contaminated(wide, items).count() == odd.count() - 3
    assert privacy.redact(wide).columns == wide.columns and privacy.redact(wide).count() == odd.count()
    assert language.keep_known_languages(wide).columns == wide.columns


# ------------------------------------------------------------------ substring dedup


def test_passage_in_many_documents(spark):
    rng = random.Random(1)
    passage = prose("shared", 7)  # 63 words
    rows = []
    for i in range(60):
        words = prose(f"own{i}", 20).split()
        at = rng.randrange(len(words))
        rows.append(document(i, " ".join(words[:at] + passage.split() + words[at:]) if i % 2 else " ".join(words)))
    got = {r["doc_id"]: r["text"] for r in substrings.remove_repeats(documents(spark, rows)).collect()}
    assert set(got) == {i for i in range(60) if i % 2 and i > 1}
    assert all("sharedq3" not in text and "own" in text for text in got.values())


def test_passages_without_marks_and_from_the_middle_of_sentences(spark):
    """Passages of 55 words, cut anywhere out of the test table's texts and set anywhere into other ones."""
    rng = random.Random(4)
    texts = [r[0] for r in duckdb.sql(f"SELECT text FROM '{SF_DIR}/documents.parquet' WHERE n_chars > 900 ORDER BY doc_id").fetchall()]
    texts.append(" ".join(f"plain{i}x{'y' * (i % 7)}" for i in range(400)))
    rows, planted = [], []
    for i, text in enumerate(texts[-60:]):
        words = text.split(" ")
        at = rng.randrange(len(words) - 55)
        host = prose(f"host{i}", 12).split()
        place = rng.randrange(len(host))
        rows += [document(2 * i, text), document(2 * i + 1, " ".join(host[:place] + words[at : at + 55] + host[place:]))]
        planted.append(2 * i + 1)
    got = {r["doc_id"]: r for r in substrings.remove_repeats(documents(spark, rows)).collect()}
    caught = sum(i in got for i in planted) / len(planted)
    assert caught >= 0.9
    assert all(f"host{i // 2}q0".capitalize() not in rows[i][1] or "Host" in got[i]["text"] for i in planted if i in got)


def test_repeats_inside_one_document_go_only_on_demand(spark):
    twice = prose("a", 4) + " " + prose("b", 4) + " " + prose("a", 4)
    docs = documents(spark, [document(1, twice), document(2, "XX!! YY!! ZZ!! " * 30), document(3, prose("c", 9))])
    assert substrings.remove_repeats(docs).count() == 0
    got = {r["doc_id"]: r for r in substrings.remove_repeats(docs, own=True).collect()}
    assert set(got) == {1, 2} and got[1]["n_own"] == got[1]["n_removed"] == 4
    assert got[1]["text"] == prose("a", 4) + " " + prose("b", 4) + " "
    both = documents(spark, [document(1, twice), document(5, prose("a", 4) + " " + prose("d", 2) + " " + prose("a", 4))])
    got = {r["doc_id"]: r for r in substrings.remove_repeats(both).collect()}
    assert set(got) == {5} and got[5]["n_removed"] == 8 and got[5]["n_own"] == 0


# ------------------------------------------------------------------ mixing


def test_mix_meets_targets(docs):
    rows = mixing.mix_sources(docs).collect()
    taken = Counter()
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    targets = {r["source"]: (r["target"], r["source_size"]) for r in rows}
    assert all(taken[s] == math.floor(t) and t <= 2 * n for s, (t, n) in targets.items())
    assert sorted(rows) == sorted(mixing.mix_sources(docs.repartition(7)).collect())


# ------------------------------------------------------------------ language


def test_language_accuracy_and_fold(docs, texts):
    rows = {r["doc_id"]: r for r in language.identify_languages(docs).collect()}
    assert all(rows[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in texts)
    held = [(rows[i]["lang_pred"], lang) for i, _, lang in texts if rows[i]["held_out"]]
    assert np.mean([a == b for a, b in held]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert language.keep_known_languages(docs).count() == len(texts)


def test_filter_has_no_false_negatives_and_many_languages():
    names = [f"l{i:03d}" for i in range(70)]
    own = language.LanguageFilter(names)
    rng = np.random.default_rng(5)
    grams = rng.integers(0, 2**63, (70, 300), dtype=np.uint64)
    for i in range(70):
        own.add(i, grams[i])
    for i in (0, 63, 64, 69):
        held, _ = own.counts(grams[i])
        assert held[i] == 300 and np.delete(held, i).max() < 30


def test_letters_only():
    own = language.LanguageFilter(["xx"])
    own.add(0, language.gram_hashes("hello"))
    assert own.predict("12 34 !")[0] == "und" and own.predict(None) == ("und", 0.0, 0.0)
    assert own.predict("Hello")[0] == "xx"


# ------------------------------------------------------------------ decontamination


def test_contamination_equals_brute_force(spark, docs, texts):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF_DIR}/benchmark.parquet'").fetchall()

    def grams(text):
        words = re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", text.lower())
        return [(tuple(words[i : i + 5]), sum(len(w.encode()) for w in words[i : i + 5])) for i in range(len(words) - 4)]

    want = {}
    wanted = {i: grams(t) for i, t in items}
    for doc_id, text, _ in texts:
        own = grams(text)
        names = {g for g, _ in own}
        for item_id, goal in wanted.items():
            if not names & {g for g, _ in goal}:
                continue
            size, best, goals = min(len(goal), len(own)), 0, Counter(g for g, _ in goal)
            for at in range(len(own) - size + 1):
                have, weight = Counter(g for g, _ in own[at : at + size]), dict(own[at : at + size]) | dict(goal)
                common = sum(weight[g] * n for g, n in (have & goals).items())
                best = max(best, common / sum(weight[g] * n for g, n in (have | goals).items()))
            if best >= 0.8:
                want[doc_id, item_id] = best
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in QUERIES["op4_benchmark_decontamination"](spark, SF_DIR).collect()}
    assert got == pytest.approx(want)
    blocks = decontamination.find_contamination(docs, spark.read.parquet(f"{SF_DIR}/benchmark.parquet"), block_bytes=2000)
    assert {(r["doc_id"], r["item_id"]) for r in blocks.collect()} == set(want)


def test_hamming_search_misses_none():
    rng = np.random.default_rng(2)
    own = decontamination.SizeClass(1, 1)
    own.prints, own.items = [int(x) for x in rng.integers(0, 2**63, 200)], list(range(200))
    own.places = [0] * 200
    own.build(3)
    asked = np.array(own.prints, np.uint64)
    for _ in range(3):
        asked = asked ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64))
    near = {(int(w), int(e)) for windows, entries in own.near(asked) for w, e in zip(windows, entries, strict=True)}
    assert {(i, i) for i in range(200)} <= near


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 8, 15, 16, 31, 55, 200, 2000])
def test_every_run_holds_a_window(n):
    step, size = decontamination.window_size(n)
    for start in range(3 * step):
        first = -(-start // step) * step
        assert first + size <= start + n
    values = np.random.default_rng(n).integers(0, 2**63, n + 40, dtype=np.uint64)
    got = decontamination.fingerprints(values, step, size)
    for i, value in enumerate(got.tolist()):
        votes = [sum(int(v) >> b & 1 for v in values[i * step : i * step + size].tolist()) for b in range(64)]
        assert value == sum(1 << b for b in range(64) if votes[b] > size // 2)


def test_edited_leak(spark):
    item = " ".join(f"bench{i}" for i in range(58))
    leaks = [document(1000, prose("x"))]
    for at in range(58):
        words = item.split()
        words[at] = "changed"
        leaks.append(document(at, f"{prose('x')} {'more ' * (at % 5)}{' '.join(words).upper()}, {prose('y')}"))
    items = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    got = decontamination.find_contamination(documents(spark, leaks), items).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(i, 7) for i in range(58)]


# ------------------------------------------------------------------ personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        d = digits(m.group())
        double = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))]
        if 14 <= len(d) <= 19 and sum(double) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m.group())) <= 15]
    return sorted(out)


def test_base_spans_equal_the_patterns(texts):
    rng = random.Random(4)
    made = ["".join(rng.choice("ab1.@-+ ()5é\n%") for _ in range(rng.randrange(60))) for _ in range(4000)]
    made += ["".join(rng.choice("0123456789-. ") for _ in range(40)) for _ in range(2000)]
    made += ["a@b@c.d x@y.z@q.r", "4111 1111-1111 1111 +1 (607) 555-1595", "0" * 50 + ".1.2.3", "x" * 600 + "@" + "d.e"]
    for text in [t for _, t, _ in texts] + made:
        assert privacy.base_spans(text) == plain_spans(text), text


def test_personal_data_query(docs, texts):
    rows = {r["doc_id"]: r for r in privacy.find_personal_data(docs).collect()}
    for doc_id, text, _ in texts:
        spans = plain_spans(text)
        joined = ",".join(f"{privacy.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert rows[doc_id]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(rows[doc_id]["spans"].split(","))
    left = privacy.redact(docs).collect()
    assert len(left) == len(texts) and not any(plain_spans(r["text"]) for r in left)
    assert all(r["n_chars"] == len(r["text"]) for r in left)


def test_redact_finds_candidates_once(spark, docs, monkeypatch):
    train, plans = privacy.train_spans, []

    def watched(found):
        plans.append(found.select(F.explode("spans").alias("s"))._jdf.queryExecution().executedPlan().toString())
        return train(found)

    monkeypatch.setattr(privacy, "train_spans", watched)
    left = privacy.redact(docs)
    assert len(plans) == 1 and plans[0].count("ArrowEvalPython") <= 1  # two in a task if Spark explodes the column of the function
    assert left._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert left.count() == docs.count()


def test_classifier_adds_announced_spans(spark):
    rows = [document(i, f"Call +1 (607) 555-{1000 + i} today. Mail a{i}@b.com now.") for i in range(30)]
    rows.append(document(100, "My phone is (607) 555-1234, or write joe [at] mail [dot] com please."))
    rows.append(document(101, "Nothing here but 12 words and 3 numbers."))
    got = {r["doc_id"]: r for r in privacy.find_personal_data(documents(spark, rows)).collect()}
    assert got[100]["n_added"] == 2 and got[100]["n_phone"] == 0 and got[101]["spans"] == ""


def test_expectation_maximisation_finds_the_bad_labeler():
    rng = np.random.default_rng(0)
    truth = rng.random(5000) < 0.4
    right = np.array([0.95, 0.9, 0.5, 0.85])
    votes = np.where(rng.random((5000, 4)) < right, truth[:, None], ~truth[:, None]) * 2 - 1
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    belief, table = privacy.expectation_maximisation(patterns, counts.astype(float))
    good = table[:, 1, 2]
    assert abs(good[2] - 0.5) < 0.06 and good[0] > 0.9
    known = {tuple(p): b for p, b in zip(patterns.tolist(), belief, strict=True)}
    assert np.mean([(known[tuple(v)] > 0.5) == t for v, t in zip(votes.tolist(), truth, strict=True)]) > 0.94


# ------------------------------------------------------------------ urls


def test_fixed_rules(spark):
    cases = {
        "http://A.Example.ORG/es/x?q#f": ("a.example.org", "/es/x", "example.org/es/", "block"),
        "https://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
        "https://badexample.org/es/1": ("badexample.org", "/es/1", "org/", "allow"),
        "x://y.com/fr/": ("y.com", "/fr/", "com/fr/", "allow"),
        "x://y.com/de/1": ("y.com", "/de/1", "com/de/", "block"),
        "x://example.org": ("example.org", "", None, "allow"),
        "x://example.org?a/b": ("example.org", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, "h", "z") for i, u in enumerate(cases)], "page_id bigint, url string, host string, tokens string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.filter_urls(pages, labels).collect()}
    assert got == dict(enumerate(cases.values()))
    assert urls.filter_urls(pages.limit(0), labels).count() == 0


def test_mined_rules_equal_brute_force(spark):
    rng = random.Random(6)
    rows, marks = [], []
    for i in range(400):
        spam = i % 5 == 0
        host = "casino.net" if spam and i % 10 == 0 else rng.choice(["news", "blog", "shop"]) + ".net"
        path = "pills/buy" if spam and i % 10 else rng.choice(["a", "b", "c"])
        rows.append((i, f"http://{host}/{path}/{i}"))
        marks.append((i, 0 if spam else 1, 0))
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    labels = spark.createDataFrame(marks + [(None, 0, 1), (0, None, None)], "doc_id bigint, quality int, toxic int")
    got = {r["page_id"]: r["verdict"] for r in urls.filter_urls(pages, labels, rules=[]).collect()}
    assert got == {i: "block" if i % 5 == 0 else "allow" for i in range(400)}


# ------------------------------------------------------------------ licenses


def test_canonical_forms_match(spark):
    rows = [
        document(1, "Copyright (c) 2020 A. B.\nlicensed under the  APACHE Licence, version 2.0\n\nCode."),
        document(2, "Released under the MIT License"),
        document(3, "This is not released under the MIT License at all."),
    ]
    got = {(r["doc_id"], r["license_id"], r["unit"]) for r in licenses.scan_licenses(documents(spark, rows), licenses.known_notices(spark)).collect()}
    assert got == {(1, "Apache-2.0", "paragraph"), (2, "MIT", "text")}


def test_whole_licenses_in_every_spelling(spark):
    """Known answers, written by hand: case, marks, copyright lines, equal spellings, line breaks and what must not match."""
    known = spark.createDataFrame([("X-1", "Use of this licence is free, organisation or not."), ("Y-1", "One.\n\nTwo & three."), ("Z-1", None), ("W-1", "")], "license_id string, text string")
    rows = {
        1: ("USE of this\n  LICENSE is free; organization or not!", {("X-1", "text")}),
        2: ("Copyright (c) 2021 Someone\nUse of this licence is free, organisation or not.\nAll rights reserved.", {("X-1", "text")}),
        3: ("Before.\n\nUse of this license is\nfree organisation or not\n\nAfter.", {("X-1", "paragraph")}),
        4: ("Before.\nuse of this license is free organization or not\nAfter.", {("X-1", "line")}),
        5: ("Use of this licence is free, organisation or not. And more.", set()),
        6: ("one\ntwo and three", {("Y-1", "text")}),
        7: ("One two", set()), 8: ("", set()), 9: (None, set()), 10: ("Copyright 2020", set()),
    }
    got = licenses.scan_licenses(documents(spark, [document(i, t) for i, (t, _) in rows.items()]), known).collect()
    assert {(r["doc_id"], r["license_id"], r["unit"]) for r in got} == {(i, *x) for i, (_, want) in rows.items() for x in want}
    assert licenses.scan_licenses(documents(spark, [document(1, "x")]), known.limit(0)).count() == 0


def test_license_lines_are_made_once_and_in_linear_time(spark):
    lines = "\n".join(f"line number {i}" for i in range(100_000)) + "\nReleased under the MIT License."
    found = licenses.scan_licenses(documents(spark, [document(1, lines)]), licenses.known_notices(spark))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.split("Generate")[1].split("_groupingexpression")[0].count("all rights reserved") == 1
    started = time.time()
    assert [(r["license_id"], r["unit"]) for r in found.collect()] == [("MIT", "line")]
    assert time.time() - started < 60


# ------------------------------------------------------------------ language models


def test_losses_equal_brute_force(spark):
    rows = [document(i, t) for i, t in enumerate(["abab ab", "bbaa", "", None, "Zz top ab", "ab" * 30])]
    target = documents(spark, [document(1, "ab ab ab"), document(2, None)])
    size = 6
    got = {r["doc_id"]: r for r in scoring.score_documents(documents(spark, rows), target, size).collect()}
    all_texts = [t.lower() for _, t, *_ in rows if t]
    best = sorted(Counter("".join(all_texts)).items(), key=lambda x: (-x[1], x[0]))[: size - 1]
    number = {c: i + 1 for i, (c, _) in enumerate(best)}

    def tokens(text):
        return [0, 0] + [number.get(c, 0) for c in text.lower()]

    def model(corpus):
        three, two, one = Counter(), Counter(), Counter()
        for t in corpus:
            x = tokens(t)
            for a, b, c in zip(x, x[1:], x[2:]):
                three[a, b, c] += 1
                two[b, c] += 1
                one[c] += 1
        total = sum(one.values())

        def p(a, b, c):
            out = (one[c] + 1) / (total + size)
            seen = sum(two[b, d] for d in range(size))
            out = 0.75 * two[b, c] / seen + 0.25 * out if seen else out
            seen = sum(three[a, b, d] for d in range(size))
            return 0.6 * three[a, b, c] / seen + 0.4 * out if seen else out

        return p

    back, goal = model(all_texts), model(["ab ab ab"])
    for i, text, *_ in rows:
        if not text:
            assert got[i]["n_tokens"] == 0 and got[i]["score"] is None
            continue
        x = tokens(text)
        loss = [[-math.log(p(*t)) for t in zip(x, x[1:], x[2:])] for p in (goal, back)]
        assert got[i]["target_loss"] == pytest.approx(np.mean(loss[0]), rel=1e-5)
        assert got[i]["score"] == pytest.approx(np.mean(loss[0]) - np.mean(loss[1]), rel=1e-4, abs=1e-6)


# ------------------------------------------------------------------ pipeline


def test_pipeline(spark, texts):
    import corpus_pipeline
    from tests.llm.test_near_dedup import brute_classes

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    leaks = {r["doc_id"] for r in QUERIES["op4_benchmark_decontamination"](spark, SF_DIR).collect()}
    expected = {i for i, _, _ in texts}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        if name == "source_mixing":
            expected = {r["doc_id"] for r in mixing.mix_sources(docs).where("taken > 0").collect()}
        docs = stage(spark, docs, SF_DIR).cache()
        if number < 4:
            assert docs.columns == columns, name
        if name == "near_dedup":
            expected = set(brute_classes([(i, t) for i, t, _ in texts]).values())
        if name == "decontamination":
            expected -= leaks
        assert {r["doc_id"] for r in docs.select("doc_id").collect()} == expected, name
    assert expected and all(len(WORD.findall(r["text"])) == r["taken"] for r in docs.collect())


def test_target_model_is_fitted_on_all_good_labels(spark):
    docs = spark.range(20_600).select(F.col("id").alias("doc_id"), F.lit("ab").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.when(F.col("doc_id") < 100, 1).alias("toxic"))
    target = scoring.labelled_target(docs, labels.union(labels))
    assert target.count() == 20_500


@pytest.mark.parametrize("held", [scoring.HELD, 40])
def test_every_character_is_a_token(spark, held):
    """400 characters, most of them rare; with few cells held in the tasks, the others are joined."""
    rng = random.Random(9)
    alphabet = [chr(0x4E00 + i) for i in range(300)] + [chr(0x430 + i) for i in range(30)] + list("abcdefghijklmnopqrstuvwxyz \U0001f600\U0001f601")
    texts = ["".join(rng.choices(alphabet, [1 / (i + 1) for i in range(len(alphabet))], k=rng.randrange(1, 80))) for _ in range(60)]
    texts += [texts[0], "", None, "".join(alphabet), "zz"]
    good = [*texts[:20], "\u0e01 only here"]
    target = documents(spark, [document(i, t) for i, t in enumerate(good)])
    docs = documents(spark, [document(i % 62, t) for i, t in enumerate(texts)]).repartition(3)
    got = sorted(((r["doc_id"], r["n_tokens"], r["target_loss"], r["background_loss"]) for r in scoring.score_documents(docs, target, held=held).collect()), key=str)
    number = {c: i for i, c in enumerate(sorted(set("".join(t or "" for t in texts))), 1)}
    size = len(number) + 1
    assert size > 300

    def model(corpus):
        three, pair, two, head, one = (Counter() for _ in range(5))
        for t in corpus:
            x = [0, 0, *(number.get(c, 0) for c in t or "")]
            for a, b, c in zip(x, x[1:], x[2:]):
                for counts, key in ((three, (a, b, c)), (pair, (a, b)), (two, (b, c)), (head, b), (one, c)):
                    counts[key] += 1

        def loss(text):
            out = 0
            x = [0, 0, *(number[c] for c in text)]
            for a, b, c in zip(x, x[1:], x[2:]):
                p = (one[c] + 1) / (one.total() + size)
                p = 0.75 * two[b, c] / head[b] + 0.25 * p if head[b] else p
                p = 0.6 * three[a, b, c] / pair[a, b] + 0.4 * p if pair[a, b] else p
                out -= math.log(p)
            return out / len(text)

        return loss

    goal, back = model(good), model(texts)
    want = sorted(((i % 62, len(t or ""), goal(t) if t else None, back(t) if t else None) for i, t in enumerate(texts)), key=str)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[2:] == ((None, None) if w[2] is None else pytest.approx(w[2:], rel=1e-5))
