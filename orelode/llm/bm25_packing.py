"""Packing of tokenised documents into windows, each filled with its seed's lexical neighbours."""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from itertools import chain, compress, count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.llm.common import mapped, once_in_worker, slices, staged

WINDOW = 2048
#: Closes every document.
END_ID = 1
#: Tokens of a shard, the part of the index that is in memory at a time, and of a task.
SHARD_TOKENS = 2_000_000
TASK_TOKENS = 32_000_000
#: The constants of BM25.
K1, B = 1.2, 0.75
#: Weights are multiples of this, so that their sums are exact and the same in any order.
UNIT = 2.0**-20
#: A term that at least one of so many open documents holds is a row of a matrix; the others have
#: postings. The matrix has at most so many entries for each posting.
COMMON = 4
#: Neighbours that are put in order at first; the others follow when a window needs them.
FIRST = 64

#: Texts of these characters have one composed form and one lower form for each character.
PLAIN = re.compile(r"[\t\n\r -~¡¿«»À-ÿ]*")
# Fixed value: how the tokenizer cuts such a text, after lowering it. No piece spans white space;
# a line break stands between the words that are cut together.
PIECE = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\s0-9a-zß-öø-ÿ]+|\n")

#: Pieces whose ids a worker remembers: under 200 MB.
REMEMBERED = 800_000
#: Texts that are tokenised together, and the bytes beyond which they are taken in halves.
TEXTS = 2_048
TEXT_BYTES = 16 << 20
#: New pieces with other letters than ASCII that go through the tokenizer as one text.
TOGETHER = 64


class Ids:
    """Ids of whole texts, as the tokenizer gives them, with the ids of pieces remembered.

    The tokenizer lowers letters, cuts a text into pieces by ``PIECE`` and drops white space;
    the ids of a text are those of its pieces. The distinct words of a batch are cut into pieces
    once. Pieces are numbered as they are met; new ones go through the tokenizer in one call, and
    their ids are told apart by the mark of a piece's end. The ids of words, then of texts, are
    taken from arrays by these numbers. Texts with characters outside of ``PLAIN``, or that may
    hold a special token, go through it as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.end = np.array([END_ID], self.kind).tobytes()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.last = np.zeros(size, bool)
        for piece, place in self.tokenizer.get_vocab().items():
            self.last[place] = piece.endswith("</w>")
        self.forget()

    def direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def forget(self) -> None:
        self.numbers: defaultdict[str, int] = defaultdict(count().__next__)
        self.numbers["\n"]  # the break between words is piece 0, which has no ids
        self.flat, self.sizes = np.empty(0, self.kind), np.zeros(1, np.int32)
        self.starts = np.zeros(1, np.int32)

    def learn(self) -> None:
        """Remembers the ids of all pieces that got a number since the last call.

        The tokenizer writes bytes as letters before it merges them, and ASCII as it is; such
        pieces go to the merges at once.
        """
        new = list(islice(reversed(self.numbers), len(self.numbers) - len(self.sizes)))[::-1]
        merged = self.tokenizer.model.tokenize
        own = [[token.id for token in merged(piece)] if piece.isascii() else None for piece in new]
        rest = [piece for piece, found in zip(new, own) if found is None]
        others = iter(self.others(rest))
        own = [next(others) if found is None else found for found in own]
        sizes = np.fromiter(map(len, own), np.int32, len(own))
        ids = np.fromiter(chain.from_iterable(own), self.kind, sizes.sum())
        self.flat = np.concatenate([self.flat, ids])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.starts = np.cumsum(self.sizes, dtype=np.int32) - self.sizes

    def others(self, new: list[str]) -> list[list[int]]:
        """The ids of each of these pieces, by the whole tokenizer."""
        lines = [" ".join(new[i : i + TOGETHER]) for i in range(0, len(new), TOGETHER)]
        found = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        ids = [place for one in found for place in one.ids]
        stops = (np.flatnonzero(self.last[ids]) + 1).tolist() if ids else []
        if len(stops) != len(new):
            return [self.tokenizer.encode(piece, add_special_tokens=False).ids for piece in new]
        return [ids[a:b] for a, b in zip([0, *stops], stops)]

    def of(self, texts: list[str]) -> list[bytes]:
        if len(self.numbers) > REMEMBERED:
            self.forget()
        plain = [
            PLAIN.fullmatch(text) is not None and not any(special in text for special in self.specials)
            for text in texts
        ]
        split = pc.ascii_split_whitespace(pa.array(list(compress(texts, plain)), pa.string()))
        words = split.flatten().dictionary_encode()
        distinct = pa.ListArray.from_arrays([0, len(words.dictionary)], words.dictionary)
        lines = pc.binary_join(distinct, "\n")[0].as_py()
        cut = PIECE.findall(f"{lines}\n".lower()) if len(words) else []
        pieces = np.fromiter(map(self.numbers.__getitem__, cut), np.int32, len(cut))
        self.learn()
        # every word ends at its break
        flat, until = taken(self.flat, self.starts, self.sizes, pieces)
        until = np.append(0, until[np.flatnonzero(pieces == 0) + 1])
        raw, until = taken(flat, until[:-1], np.diff(until), words.indices.to_numpy())
        ids = raw.tobytes()
        edges = (until[split.value_lengths().to_numpy().cumsum()] * self.kind.itemsize).tolist()
        runs = zip(chain((0,), edges), edges)
        return [
            (ids[slice(*next(runs))] if whole else self.direct(text)) + self.end
            for text, whole in zip(texts, plain)
        ]


def taken(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` at these places, one after another, and where each begins and the
    last one ends."""
    own = sizes[places]
    until = np.append(0, np.cumsum(own, dtype=np.int64))
    # a run's entries stand together: its start, then one on for each further entry
    steps = np.repeat(starts[places] - until[:-1], own)
    steps += np.arange(len(steps))
    return flat[steps], until


def signature(ids: np.ndarray, orders: list[np.ndarray], places: np.ndarray) -> list[int]:
    """The first of the terms in each of two random orders of the vocabulary; texts with common
    terms tend to share them. They are given by their places in a third order: the first terms
    of long texts are early ones, and long texts would stand together."""
    return [int(places[ids[order[ids].argmin()]]) for order in orders]


def halved(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ``TEXT_BYTES`` of text, or of one row."""
    half = batch.num_rows // 2
    if half and batch.column(1).nbytes > TEXT_BYTES:
        yield from halved(batch.slice(0, half))
        yield from halved(batch.slice(half))
    else:
        yield batch


def id_rows(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    ids = once_in_worker(f"ids of {path}", lambda: Ids(path))
    *orders, places = [np.random.default_rng(seed).permutation(len(ids.last)).astype(np.int32) for seed in (1, 2, 3)]
    for part in chain.from_iterable(map(halved, slices(batches, TEXTS))):
        raw = ids.of([text or "" for text in part.column(1).to_pylist()])
        marks = [signature(np.frombuffer(r, ids.kind), orders, places) for r in raw]
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array([len(r) // ids.kind.itemsize for r in raw], pa.int64()),
             pa.array([m[0] for m in marks], pa.int64()), pa.array([m[1] for m in marks], pa.int64()),
             pa.array(raw, pa.binary())],
            ["doc", "n", "near", "next", "ids"],
        )


def vocabulary_size(spark: SparkSession, path: str) -> int:
    """Read by a worker, which needs the tokenizer anyway; the driver's memory is for plans."""

    def count_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = once_in_worker(f"ids of {path}", lambda: Ids(path))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(ids.last)] * batch.num_rows, pa.int64())], ["size"])

    return spark.range(0, 1, 1, 1).mapInArrow(count_ids, "size long").first()[0]


def document_frequencies(batches: Iterator[pa.RecordBatch], kind: np.dtype, size: int) -> Iterator[pa.RecordBatch]:
    """Of each term of the vocabulary, the documents of this task that hold it."""
    counts = np.zeros(size, np.int64)
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            # adds one to each distinct term: repeated places of an index are written once
            counts[np.frombuffer(raw, kind)] += 1
    terms = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int64()), pa.array(counts[terms])], ["term", "docs"])


class Shard:
    """An inverted index over the documents of a shard, from which documents are used up."""

    def __init__(self, items: list, idf: np.ndarray, mean: float, window: int):
        self.items, self.window = items, window
        pool = [(i, len(ids) - len(ids) % window) for i, (_, ids) in enumerate(items) if len(ids) % window]
        self.pool = pool
        self.starts = np.array([start for _, start in pool], np.int64)
        sizes = np.array([len(items[i][1]) - start for i, start in pool], np.int64)
        self.left = sizes.copy()
        terms, counts, owners = [], [], []
        for place, (i, start) in enumerate(pool):
            found, times = np.unique(items[i][1][start:], return_counts=True)
            terms.append(found.astype(np.int64))
            counts.append(times)
            owners.append(np.full(len(found), place))
        if not pool:
            return
        cuts = np.cumsum([0] + [len(t) for t in terms])
        term, count, owner = map(np.concatenate, (terms, counts, owners))
        weight = idf[term] * count * (K1 + 1) / (count + K1 * (1 - B + B * sizes[owner] / max(mean, 1.0)))
        weight = np.rint(weight / UNIT) * UNIT
        # terms of the shard by number, so that the index is as long as they are
        met = np.zeros(len(idf), bool)
        met[term] = True
        number = np.cumsum(met) - 1
        term = number[term]
        self.terms, self.cuts, self.known = term, cuts, int(number[-1]) + 1
        order = np.argsort(term.astype(np.uint16) if self.known <= 1 << 16 else term, kind="stable")
        self.index(term[order], owner[order], weight[order])

    def index(self, term: np.ndarray, owner: np.ndarray, weight: np.ndarray) -> None:
        """Takes postings in the order of terms, then documents. Common terms are rows of a matrix
        over the open documents, the others have lists."""
        self.term, self.owner, self.weight = term, owner, weight
        self.open = np.flatnonzero(self.left)
        holders = np.bincount(term, minlength=self.known)
        common = (holders > 0) & (holders * COMMON >= len(self.open))
        self.row = np.where(common, np.cumsum(common) - 1, -1)
        dense = common[term]
        column = np.zeros(len(self.left), np.int64)
        column[self.open] = np.arange(len(self.open))
        self.matrix = np.zeros((int(common.sum()), len(self.open)))
        self.matrix[self.row[term[dense]], column[owner[dense]]] = weight[dense]
        self.listed, self.listed_weight = owner[~dense], weight[~dense]
        self.edges = np.append(0, np.cumsum(np.where(common, 0, holders))).tolist()

    def forget(self) -> None:
        """Leaves out the postings of used documents once they are many."""
        if 4 * np.count_nonzero(self.left) < 3 * len(self.open):
            open_rows = self.left[self.owner] > 0
            self.index(self.term[open_rows], self.owner[open_rows], self.weight[open_rows])

    def scores(self, place: int) -> np.ndarray:
        """BM25 of all documents for the terms of one."""
        edges, terms = self.edges, self.terms[self.cuts[place] : self.cuts[place + 1]]
        rows = self.row[terms]
        asked = np.zeros(len(self.matrix))
        asked[rows[rows >= 0]] = 1
        scores = np.zeros(len(self.pool))
        scores[self.open] = asked @ self.matrix
        runs = [slice(edges[t], edges[t + 1]) for t in terms[rows < 0].tolist()]
        if runs:
            owners = np.concatenate([self.listed[run] for run in runs])
            weights = np.concatenate([self.listed_weight[run] for run in runs])
            scores += np.bincount(owners, weights, len(scores))
        return scores

    def neighbours(self, place: int) -> Iterator[int]:
        """Unused documents by falling BM25 score, then the others in the order of the shard."""
        self.forget()
        scores = self.scores(place)
        scores[self.left == 0] = 0
        scores[place] = 0
        found = np.flatnonzero(scores)
        # a window needs few of them: the best are put in order first, all that tie with them too
        if len(found) > 4 * FIRST:
            least = np.partition(scores[found], len(found) - FIRST)[len(found) - FIRST]
            high = found[scores[found] >= least]
            yield from high[np.argsort(-scores[high], kind="stable")].tolist()
            found = found[scores[found] < least]
        yield from found[np.argsort(-scores[found], kind="stable")].tolist()
        for other in range(self.next, len(self.pool)):
            if self.left[other] and other != place:
                yield other

    def sequences(self) -> Iterator[list[tuple[int, int, int]]]:
        """Lists of (item, start, length). Whole windows of long documents stand alone; what is
        left of each document is a seed or a neighbour, and the neighbour that overflows a
        window is cut there and seeds the next one."""
        for i, (_, ids) in enumerate(self.items):
            for start in range(0, len(ids) - self.window + 1, self.window):
                yield [(i, start, self.window)]
        self.next, seed = 0, None
        while True:
            if seed is None:
                while self.next < len(self.pool) and not self.left[self.next]:
                    self.next += 1
                if self.next == len(self.pool):
                    return
                seed = self.next
            room, made, cut = self.window, [], None
            for place in self.filling(seed):
                length = int(min(room, self.left[place]))
                made.append((self.pool[place][0], int(self.starts[place]), length))
                self.starts[place] += length
                self.left[place] -= length
                room -= length
                if not room:
                    cut = place if self.left[place] else None
                    break
            yield made
            seed = cut

    def filling(self, seed: int) -> Iterator[int]:
        yield seed
        yield from self.neighbours(seed)


def piece_rows(
    batches: Iterator[pa.RecordBatch], idf: np.ndarray, mean: float, window: int, kind: np.dtype, with_ids: bool
) -> Iterator[pa.RecordBatch]:
    base, made = TaskContext.get().partitionId() << 32, 0

    def packed(items: list) -> Iterator[pa.RecordBatch]:
        nonlocal made
        rows = []
        for pieces in Shard(items, idf, mean, window).sequences():
            offset = 0
            for i, start, length in pieces:
                doc, ids = items[i]
                part = ids[start : start + length].astype("<u4")
                rows.append((doc, start, length, zlib.crc32(part.tobytes()), len(ids), base + made, offset,
                             part if with_ids else None))
                offset += length
            made += 1
            if len(rows) >= 4_096:
                yield row_batch(rows)
                rows = []
        if rows:
            yield row_batch(rows)

    items, held = [], 0
    for part in slices(batches):
        for doc, raw in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            items.append((doc, np.frombuffer(raw, kind)))
            held += len(items[-1][1])
            if held >= SHARD_TOKENS:
                yield from packed(items)
                items, held = [], 0
    if items:
        yield from packed(items)


def row_batch(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows))
    arrays = [pa.array(column, pa.int64()) for column in columns[:7]]
    arrays.append(pa.array([None if x is None else x.astype(np.int32) for x in columns[7]], pa.list_(pa.int32())))
    names = ["doc", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    return pa.RecordBatch.from_arrays(arrays, names)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row for each piece: ``key, start, length, ids_crc32, doc_tokens, sequence_id, offset``
    and ``ids`` (null unless asked for).

    Every document is tokenised as a whole and closed by ``END_ID``; each id is in exactly one
    piece. Document frequencies are counted over all documents and are as many as the
    vocabulary. Documents are put in the order of two hashes of their terms, which brings those
    with common terms together and splits any group by key; along that order they fall into
    shards, each with an inverted index of its own. All terms of a seed ask the shard's index
    for unused documents, by BM25, and these fill its window; the last one is cut to fit. Only the
    last window of a shard may be short.

    A null or empty text is a document of one id. Keys may be null or repeat: rows are separate
    documents. Texts of any length are packed whole. An empty table gives no rows; other columns
    are not read.
    """
    size = vocabulary_size(docs.sparkSession, tokenizer)
    kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    found = staged(
        mapped(
            rows, partial(id_rows, path=tokenizer), "doc long, n long, near long, next long, ids binary"
        ),
        "ids",
    )
    total, count = found.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    frequencies = (
        found.select("ids")
        .mapInArrow(partial(document_frequencies, kind=kind, size=size), "term long, docs long")
        .groupBy("term")
        .agg(F.sum("docs").alias("docs"))
        .toArrow()  # at most one row for each id of the vocabulary
    )
    holders = np.zeros(size)
    holders[frequencies.column("term").to_numpy()] = frequencies.column("docs").to_numpy()
    idf = np.log1p((count - holders + 0.5) / (holders + 0.5))
    shared = found.sparkSession.sparkContext.broadcast(idf)
    mean = total / max(count, 1)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from piece_rows(batches, shared.value, mean, window, kind, with_ids)

    order = ["near", "next", "doc", "n"]
    placed = found.repartitionByRange(max(1, -(-total // TASK_TOKENS)), *order).sortWithinPartitions(*order)
    pieces = placed.select("doc", "ids").mapInArrow(
        pack,
        "doc long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
        "offset long, ids array<int>",
    )
    return pieces.withColumn("doc", F.col("doc").cast(docs.schema[key].dataType)).withColumnRenamed("doc", key)
