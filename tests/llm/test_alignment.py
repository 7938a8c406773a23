import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import SF_DIR, clashing, document, documents
from tidemark.llm.alignment import (
    ByteLevel, Pieces, align_digests, align_tokenizers, merge_path, merge_piece, score_links, shared_ends, stitch,
)
from tidemark.llm.queries import tokenizer_file

A, B = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoders():
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    return tokenizer, sentencepiece.SentencePieceProcessor(model_file=B), ByteLevel(A).pieces, Pieces(B).pieces


def brute_groups(text, encoders):
    """Groups by the definition, from the encoders themselves."""
    tokenizer, model, a_bytes, b_bytes = encoders
    if not text:
        return []
    a, b = tokenizer.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
    raw = (" " + text).encode()
    if b"".join(a_bytes[i] for i in a) != raw or b"".join(b_bytes[i] for i in b) != raw:
        return []
    a_ends = np.cumsum([len(a_bytes[i]) for i in a]).tolist()
    b_ends = np.cumsum([len(b_bytes[i]) for i in b]).tolist()
    shared = set(a_ends) & set(b_ends)

    def cut(ids, ends):
        out = [[]]
        for i, e in zip(ids, ends, strict=True):
            out[-1].append(i)
            if e in shared:
                out.append([])
        return out[:-1]

    return list(zip(cut(a, a_ends), cut(b, b_ends), strict=True))


def brute_scores(texts, encoders):
    groups = [brute_groups(t, encoders) for t in texts]
    links = [[(a[-1], b[-1]) for a, b in own] for own in groups]
    count = Counter(x for own in links for x in own)
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for own, pairs in zip(groups, links, strict=True):
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own)
        out.append((
            sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), len(pairs),
            sum(count[p] == best[p[1]] for p in pairs), sum(count[p] for p in pairs),
            hashlib.sha256(said.encode()).hexdigest() if own else "",
        ))
    return out


ODD = [
    "a", "  two  spaces ", "\n\n\tline\r\n", "▁ mark", "x▁y", "<|endoftext|> and <s> </s> <unk> <0x41>", "1234567890 12,345.67",
    "日本語のテキスト 漢字", "\U0001f600\U0001f468‍\U0001f469 é é", "it's we'll THEY'RE", "\x00nul", "  　wide", "ﬁ ﬀ ß İ",
    "word" * 300, "!" * 500, " " * 400, "\n" * 100, "а" * 200, None, "", " ",
]


@pytest.mark.parametrize("work", [32768, 7])
def test_equals_brute_force(spark, encoders, work):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(25).collect()]
    texts = [t for _, t in rows] + ODD
    got = score_links(align_digests(documents(spark, [document(i, t) for i, t in enumerate(texts)]).repartition(3), A, B, work, 2000))
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = {r["doc_id"]: tuple(r[n] for n in names) for r in got.collect()}
    assert [got[i] for i in range(len(texts))] == brute_scores(texts, encoders)


def test_encoder_agrees_with_the_file_over_unicode(encoders):
    tokenizer, _, _, _ = encoders
    own = ByteLevel(A)
    signs = [c for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    texts = [f" a{chr(c)}b {chr(c)}1 {chr(c)}{chr(c)}, {chr(c)}  {chr(c)}x\n{chr(c)}" for c in signs]
    assert own.encode(texts) == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


ends = st.lists(st.integers(1, 4), min_size=1, max_size=60).map(lambda steps: np.cumsum(steps))


@settings(max_examples=200, deadline=None)
@given(ends, ends, st.integers(1, 20))
def test_pieces_stitch_to_the_whole(a, b, work):
    whole = merge_piece(a, b)
    cuts = merge_path(a, b, work)
    assert all(abs((i2 - i1) + (j2 - j1) - work) <= 1 for (i1, j1), (i2, j2) in zip(cuts, cuts[1:-1], strict=False))
    pieces = [merge_piece(a[i1:i2], b[j1:j2]) for (i1, j1), (i2, j2) in zip(cuts, cuts[1:], strict=False)]
    got = stitch(pieces)
    assert [x.tolist() for x in got] == [x.tolist() for x in whole[:2]]
    i, j = shared_ends(a, b)
    assert a[i].tolist() == b[j].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_long_text_and_copies(spark, encoders):
    rng = random.Random(5)
    long = " ".join(f"w{rng.randrange(300)}" for _ in range(20_000))
    texts = [long, "same text"] + ["same text"] * 40
    got = score_links(align_digests(documents(spark, [document(i, t) for i, t in enumerate(texts)]), A, B, work=1000))
    want = brute_scores(texts, encoders)
    assert {(r["doc_id"], r["n_groups"], r["count_sum"], r["groups_sha256"]) for r in got.collect()} == {
        (i, w[2], w[5], w[6]) for i, w in enumerate(want)
    }


def test_odd_and_empty(spark, odd, empty):
    got = score_links(align_digests(clashing(odd), A, B)).collect()
    assert len(got) == odd.count()
    assert sorted(map(str, got)) == sorted(map(str, score_links(align_digests(odd, A, B)).collect()))
    assert all(r["n_a"] == r["n_b"] == r["count_sum"] == 0 and r["groups_sha256"] == "" for r in got if r["doc_id"] in (3, 4))
    assert len([r for r in got if r["doc_id"] is None]) == 2
    assert score_links(align_digests(empty, A, B)).count() == 0


def test_real_output_gives_the_texts_back(spark, encoders):
    docs = documents(spark, [document(1, "One word, zwei Wörter."), document(2, None)])
    row, none = sorted(align_tokenizers(docs, A, B).collect(), key=lambda r: r["doc_id"])
    _, _, a_bytes, b_bytes = encoders
    for ids, sizes, pieces in ((row["a_ids"], row["a_sizes"], a_bytes), (row["b_ids"], row["b_sizes"], b_bytes)):
        assert b"".join(pieces[i] for i in ids).decode() == " One word, zwei Wörter." and sum(sizes) == len(ids)
    assert none["a_ids"] == none["b_sizes"] == []
