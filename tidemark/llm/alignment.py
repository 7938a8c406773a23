"""Two tokenizers' tokens of one text, aligned by merging their ends piece by piece, and the links that this gives over a corpus."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import write_through

#: Token ids of the second tokenizer stay below this; a pair's number is ``a * PAIR + b``.
PAIR = 1 << 32
#: Bytes that are encoded at a time.
_CHUNK = 1 << 18

# ---------------------------------------------------------------- the two vocabularies


def _byte_signs() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: visible Latin-1 signs themselves, others from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """The byte-level vocabulary of a JSON file; special tokens are ordinary text."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        signs = _byte_signs()
        added = {t["id"] for t in model.get("added_tokens", ())}
        self.pieces = {i: bytes(signs[c] for c in t) for t, i in model["model"]["vocab"].items() if i not in added}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        ids = [model["model"]["vocab"]["".join(m)] for m in merges]
        before = model["pre_tokenizer"]
        if ids == sorted(set(ids)) and before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and not model["normalizer"]:
            # Merges in the order of their ids are what this encoder takes, in a quarter of the time.
            import tiktoken
            from public_tokenizers import PATTERN

            encoding = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks={b: i for i, b in self.pieces.items()}, special_tokens={})
            self.encode = lambda texts: [encoding.encode_ordinary(t) for t in texts]
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True
            self.encode = lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


class Pieces:
    """A sentence-piece vocabulary, which puts a space before a text; bytes stand for signs that it does not have."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.pieces[i] = bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()
        self.encode = lambda texts: model.encode(texts, num_threads=1)


@lru_cache(maxsize=4)
def _vocabulary(kind: type, path: str) -> tuple[Callable, list[bytes], np.ndarray]:
    """How to encode, the bytes of each id, and their number."""
    own = kind(path)
    pieces = [own.pieces.get(i, b"") for i in range(max(own.pieces) + 1)]
    if not all(own.pieces.values()):
        raise ValueError(f"{path} has a token without bytes")
    return own.encode, pieces, np.array([len(p) for p in pieces], np.int64)


# ---------------------------------------------------------------- merging


def shared_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the rising ends ``a`` and ``b`` at which both have the same end."""
    if not a.size or not b.size:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.searchsorted(a, b)
    hit = np.flatnonzero(a[np.minimum(at, a.size - 1)] == b)
    return at[hit], hit


def merge_path(a: np.ndarray, b: np.ndarray, work: int) -> list[tuple[int, int]]:
    """Where to cut ``a`` and ``b`` so that each piece has about ``work`` ends of the merged order, first and last cut included.

    A piece's first end lies on a diagonal of the grid of both; a binary search
    on it finds the place that the merge passes. Equal ends stay together, so a
    piece has at most one end more.
    """
    cuts = [(0, 0)]
    for d in range(work, a.size + b.size, work):
        low, high = max(0, d - b.size), min(d, a.size)
        while low < high:
            i = (low + high) // 2
            if a[i] <= b[d - i - 1]:
                low = i + 1
            else:
                high = i
        i, j = low, d - low
        if i and j < b.size and a[i - 1] == b[j]:
            j += 1
        cuts.append((i, j))
    return [*cuts, (a.size, b.size)]


def merge_piece(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int, int]:
    """A- and B-tokens of each group that a piece closes, and those left open at its end."""
    i, j = shared_ends(a, b)
    a_sizes, b_sizes = np.diff(i, prepend=-1), np.diff(j, prepend=-1)
    return a_sizes, b_sizes, a.size - int(a_sizes.sum()), b.size - int(b_sizes.sum())


def stitch(pieces: list[tuple[np.ndarray, np.ndarray, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The groups' sizes over all pieces in order: what one leaves open belongs to the first group that is closed after it."""
    a_all, b_all, a_open, b_open = [], [], 0, 0
    for a, b, a_left, b_left in pieces:
        if a.size:
            a, b = a.copy(), b.copy()
            a[0] += a_open
            b[0] += b_open
            a_all.append(a)
            b_all.append(b)
            a_open, b_open = a_left, b_left
        else:
            a_open, b_open = a_open + a_left, b_open + b_left
    none = np.empty(0, np.int64)
    return np.concatenate([none, *a_all]), np.concatenate([none, *b_all])


# ---------------------------------------------------------------- Spark


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType = pa.int32()) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum(sizes)))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    return np.asarray(column.flatten()), np.asarray(column.value_lengths())


def _encoded(texts: list[str], vocabularies: tuple) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ids and ends of both tokenizers for all texts, one after the other; a text that either does not give back has none."""
    (encode_a, bytes_a, length_a), (encode_b, bytes_b, length_b) = vocabularies
    raw = [(" " + t).encode("utf-8", "surrogatepass") for t in texts]
    both = []
    for encoded, pieces in ((encode_a([" " + t for t in texts]), bytes_a), (encode_b(texts), bytes_b)):
        both.append((encoded, [b"".join(map(pieces.__getitem__, ids)) == r for ids, r in zip(encoded, raw, strict=True)]))
    sound = [bool(t) and x and y for t, x, y in zip(texts, both[0][1], both[1][1], strict=True)]
    out = []
    for (encoded, _), length in zip(both, (length_a, length_b), strict=True):
        kept = [ids if ok else () for ids, ok in zip(encoded, sound, strict=True)]
        sizes = np.array([len(ids) for ids in kept], np.int64)
        flat = np.fromiter(chain.from_iterable(kept), np.int64, int(sizes.sum()))
        out.append((flat, sizes, np.cumsum(length[flat])))
    return out


_LISTS = ["a_ids", "b_ids", "a_sizes", "b_sizes"]
_TYPES = ", ".join(f"{c} array<int>" for c in _LISTS)
_DIGESTS = ["n_a", "n_b", "n_groups", "groups_sha256", "pairs"]
_DIGEST_TYPES = "n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>"
_NAMES = ["doc_id", "row", "block", "piece", "pieces", "a_start", "b_start", *_LISTS, *_DIGESTS]


@lru_cache(maxsize=1)
def _signs(top: int) -> list[str]:
    """Each id below ``top`` with a mark that tells what follows it: another of its group, the group's other side, the next group."""
    return [f"{i}{mark}" for mark in ",|;" for i in range(top)]


def _digests(a_ids: pa.ListArray, b_ids: pa.ListArray, a_sizes: pa.ListArray, b_sizes: pa.ListArray) -> list[pa.Array]:
    """The columns ``n_a, n_b, n_groups, groups_sha256, pairs`` of rows of lists."""
    (a, n_a), (b, n_b), (a_sizes, n), (b_sizes, _) = (_flat(c) for c in (a_ids, b_ids, a_sizes, b_sizes))
    top = 1 << int(max(a.max(initial=1), b.max(initial=1))).bit_length()
    a_last, b_last = np.cumsum(a_sizes) - 1, np.cumsum(b_sizes) - 1
    told_a, told_b = a.astype(np.int64), b.astype(np.int64)
    told_a[a_last] += top
    told_b[b_last] += 2 * top
    order = np.empty(a.size + b.size, np.int64)
    order[np.arange(a.size) + np.repeat(np.cumsum(b_sizes) - b_sizes, a_sizes)] = told_a
    order[np.arange(b.size) + np.repeat(np.cumsum(a_sizes), b_sizes)] = told_b
    said = list(map(_signs(top).__getitem__, order.tolist()))
    edges = np.concatenate(([0], np.cumsum(n_a + n_b))).tolist()
    sha = [hashlib.sha256("".join(said[x:y])[:-1].encode()).hexdigest() if y > x else "" for x, y in zip(edges, edges[1:], strict=False)]
    pairs = a[a_last].astype(np.int64) * PAIR + b[b_last]
    return [pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()), pa.array(n, pa.int64()), pa.array(sha, pa.string()), _lists(pairs, n, pa.int64())]


def _tokens(docs: DataFrame, a_path: str, b_path: str, work: int, block_bytes: int, digests: bool) -> DataFrame:
    """A row per text whose merge is one piece of work, already merged; of others a row per piece, not yet merged."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabularies = (_vocabulary(ByteLevel, a_path), _vocabulary(Pieces, b_path))
        here, row, seen = TaskContext.get().partitionId() << 40, 0, 0
        for batch in batches:
            edges = np.cumsum([0, *pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()])
            low = 0
            while low < batch.num_rows:
                high = min(batch.num_rows, max(low + 1, int(np.searchsorted(edges, edges[low] + _CHUNK))))
                texts = [t or "" for t in batch.column(1).slice(low, high - low).to_pylist()]
                yield from merged(batch.column(0).slice(low, high - low), texts, vocabularies, here + row, here + seen // block_bytes)
                row, seen, low = row + high - low, seen + int(edges[high] - edges[low]), high

    def merged(ids: pa.Array, texts: list[str], vocabularies: tuple, row: int, block: int) -> Iterator[pa.RecordBatch]:
        (a, a_count, a_ends), (b, b_count, b_ends) = _encoded(texts, vocabularies)
        a_at, b_at = np.concatenate(([0], np.cumsum(a_count))), np.concatenate(([0], np.cumsum(b_count)))
        long = a_count + b_count > work
        i, j = shared_ends(a_ends, b_ends)
        a_sizes, b_sizes = np.diff(i, prepend=-1), np.diff(j, prepend=-1)
        groups = np.diff(np.searchsorted(i, a_at))
        short = np.flatnonzero(~long)
        keep_a, keep_b, keep_g = np.repeat(~long, a_count), np.repeat(~long, b_count), np.repeat(~long, groups)
        n = short.size
        lists = [_lists(a[keep_a], a_count[short]), _lists(b[keep_b], b_count[short]), _lists(a_sizes[keep_g], groups[short]), _lists(b_sizes[keep_g], groups[short])]
        rest = [pa.nulls(n, pa.int64())] * 3 + [pa.nulls(n, pa.string()), pa.nulls(n, pa.list_(pa.int64()))]
        if digests:
            lists, rest = [pa.nulls(n, pa.list_(pa.int32()))] * 4, _digests(*lists)
        yield pa.RecordBatch.from_arrays([
            ids.take(pa.array(short)), pa.array(row + short), pa.array(np.full(n, block)), pa.array(np.zeros(n, np.int32)), pa.array(np.ones(n, np.int32)),
            pa.array(np.zeros(n, np.int64)), pa.array(np.zeros(n, np.int64)),
            *lists, *rest,
        ], names=_NAMES)
        for r in np.flatnonzero(long).tolist():
            own_a, own_b = slice(a_at[r], a_at[r + 1]), slice(b_at[r], b_at[r + 1])
            cuts = np.array(merge_path(a_ends[own_a], b_ends[own_b], work))
            starts_a, starts_b = np.concatenate(([0], a_ends))[own_a.start + cuts[:-1, 0]], np.concatenate(([0], b_ends))[own_b.start + cuts[:-1, 1]]
            n = len(cuts) - 1
            none = pa.nulls(n, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(np.full(n, r))), pa.array(np.full(n, row + r)), pa.array(np.full(n, block)), pa.array(np.arange(n, dtype=np.int32)), pa.array(np.full(n, n, np.int32)),
                pa.array(starts_a), pa.array(starts_b),
                _lists(a[own_a], np.diff(cuts[:, 0])), _lists(b[own_b], np.diff(cuts[:, 1])), none, none,
                *[pa.nulls(n, pa.int64())] * 3, pa.nulls(n, pa.string()), pa.nulls(n, pa.list_(pa.int64())),
            ], names=_NAMES)

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, row long, block long, piece int, pieces int, a_start long, b_start long, {_TYPES}, {_DIGEST_TYPES}"
    )


def _aligned(docs: DataFrame, a_path: str, b_path: str, work: int, block_bytes: int, digests: bool) -> DataFrame:
    """Rows of lists, or of digests: texts of one piece as they are, others after their pieces were merged and stitched."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    tokens = write_through(_tokens(docs, a_path, b_path, work, block_bytes, digests), "tokens")
    made = _DIGESTS if digests else _LISTS
    columns = ["doc_id", "row", "block", *made]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = (_vocabulary(ByteLevel, a_path)[2], _vocabulary(Pieces, b_path)[2])
        for batch in batches:
            for r in range(batch.num_rows):
                one = batch.slice(r, 1)
                ends = [
                    start[0].as_py() + np.cumsum(length[np.asarray(ids.flatten())])
                    for start, ids, length in zip((one.column("a_start"), one.column("b_start")), (one.column("a_ids"), one.column("b_ids")), lengths, strict=True)
                ]
                a, b, a_left, b_left = merge_piece(*ends)
                yield pa.RecordBatch.from_arrays([
                    *(one.column(c) for c in ("doc_id", "row", "block", "piece", "a_ids", "b_ids")),
                    _lists(a, np.array([a.size])), _lists(b, np.array([b.size])), pa.array([a_left], pa.int64()), pa.array([b_left], pa.int64()),
                ], names=["doc_id", "row", "block", "piece", "a_ids", "b_ids", "a_sizes", "b_sizes", "a_left", "b_left"])

    def join(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("piece")
        lists = {c: [np.asarray(x.values) for x in table.column(c)] for c in ("a_ids", "b_ids", "a_sizes", "b_sizes")}
        left = [table.column(c).to_pylist() for c in ("a_left", "b_left")]
        sizes = stitch(list(zip(lists["a_sizes"], lists["b_sizes"], *left, strict=True)))
        whole = [_lists(x, np.array([x.size])) for x in (np.concatenate(lists["a_ids"]), np.concatenate(lists["b_ids"]), *sizes)]
        whole = _digests(*whole) if digests else whole
        return pa.table([*(table.column(c).slice(0, 1) for c in columns[:3]), *whole], names=columns)

    pieces = tokens.where("pieces > 1").repartition("row", "piece")
    closed = pieces.mapInArrow(merge, f"doc_id {kind}, row long, block long, piece int, {_TYPES}, a_left long, b_left long")
    stitched = closed.groupBy("row").applyInArrow(join, f"doc_id {kind}, row long, block long, {_DIGEST_TYPES if digests else _TYPES}")
    return tokens.where("pieces = 1").select(columns).union(write_through(stitched, "stitched"))


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, work: int = 32768, block_bytes: int = 1 << 21) -> DataFrame:
    """``doc_id, row, block, a_ids, b_ids, a_sizes, b_sizes`` per row of ``docs (doc_id, text)``.

    A space and the text are encoded by the byte-level vocabulary ``a_path``, the
    text by the sentence-piece vocabulary ``b_path``, which adds the space; the
    files lie where every executor finds them. Offsets at which a token of both
    ends cut the tokens into groups: ``a_sizes`` and ``b_sizes`` are each group's
    numbers of tokens, in order.

    The ends of a text are merged in pieces of ``work`` ends, found by binary
    searches on diagonals. Pieces of texts that have several are dealt to the
    tasks anew and merged by themselves; of a text then only its pieces meet, to
    join the groups that cross their edges. Texts of one piece stay in place.

    Null and empty texts, and those that either vocabulary does not give back
    byte by byte, have empty lists. ``row`` numbers the rows, repeated ones too;
    ``block`` is shared by rows that one task read, of about ``block_bytes``
    bytes. An empty table gives an empty one.
    """
    return _aligned(docs, a_path, b_path, work, block_bytes, False).select("doc_id", "row", "block", *_LISTS)


def align_digests(docs: DataFrame, a_path: str, b_path: str, work: int = 32768, block_bytes: int = 1 << 21) -> DataFrame:
    """``doc_id, row, block, n_a, n_b, n_groups, groups_sha256, pairs``: :func:`align_tokenizers`, with a digest instead of its lists.

    The digest is of ``a1,a2|b1;a3|b2,b3``, ids by group; it is empty for a row
    without tokens. ``pairs`` has a number per link: the last tokens of a group
    end together. Digests are made where the groups are, so that no list of
    tokens is written but those of texts in pieces.
    """
    return _aligned(docs, a_path, b_path, work, block_bytes, True).select("doc_id", "row", "block", *_DIGESTS)


def block_pairs(digests: DataFrame) -> DataFrame:
    """``block, pair, n``: the links of each block by pair, added up in the task; a block that two tasks read has two parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = np.asarray(batch.column("block"))
            edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for low, high in zip(edges, edges[1:], strict=False):  # a block's rows lie together
                block = blocks[low]
                pair, count = np.unique(_flat(batch.column("pairs").slice(low, high - low))[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(pair.size, block)), pa.array(pair), pa.array(count.astype(np.int64))], names=["block", "pair", "n"]
                )

    return digests.select("block", "pairs").mapInArrow(run, "block long, pair long, n long")


def link_counts(pairs: DataFrame) -> DataFrame:
    """``pair, count, best`` of ``pairs (pair, n)``: the links of the corpus by pair, and whether none of its B id has more."""
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("count"))
    same_b = Window.partitionBy(F.pmod("pair", F.lit(PAIR)))
    return counts.select("pair", "count", (F.col("count") == F.max("count").over(same_b)).alias("best"))


def score_links(digests: DataFrame) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per row of :func:`align_digests`.

    ``n_best`` are links whose pair has the most links of its B id over the whole
    corpus, ties included; ``count_sum`` adds up the corpus' counts of the links'
    pairs. Each block gets the counts of the pairs that it has, and no more; no
    table of all pairs is sent to a task.
    """
    kind = digests.schema["doc_id"].dataType.simpleString()
    pairs = write_through(block_pairs(digests), "pairs")
    counts = write_through(link_counts(pairs), "counts")
    known = pairs.select("block", "pair").join(counts, "pair").select(F.col("block").alias("of"), "pair", "count", "best")

    def score(rows: pa.Table, own: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        pairs, n = _flat(rows.column("pairs").combine_chunks())
        best, total = np.zeros(rows.num_rows, np.int64), np.zeros(rows.num_rows, np.int64)
        if pairs.size:
            pair = np.asarray(own.column("pair"))
            order = np.argsort(pair)
            at = order[np.searchsorted(pair, pairs, sorter=order)]
            edges = np.concatenate(([0], np.cumsum(n)))
            for out, name in ((best, "best"), (total, "count")):
                sums = np.concatenate(([0], np.cumsum(np.asarray(own.column(name).combine_chunks().cast(pa.int64()))[at])))
                out[:] = sums[edges[1:]] - sums[edges[:-1]]
        done = [rows.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")]
        return pa.table([*done, pa.array(n, pa.int64()), pa.array(best), pa.array(total), rows.column("groups_sha256")], names=_SCORES)

    return digests.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(
        score, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    )


_SCORES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
