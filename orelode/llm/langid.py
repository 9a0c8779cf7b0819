"""Language of texts from averaged embeddings of hashed subwords and a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelode.llm.common import mapped, slices

UNKNOWN = "und"

#: Hash buckets of subwords, and the length of their embeddings.
BUCKETS = 1 << 14
WIDTH = 16
#: Bytes of a subword; a space stands for the start and end of a word.
SIZES = (1, 2, 3, 4)

#: Bounds of the training table: labelled rows for each language, and for all of them. Beyond
#: 20 languages each has an equal part of the latter, and one row at least.
ROWS_PER_LANGUAGE = 400
ROWS = 8_000

#: A calibrated probability below this is a rejection.
REJECT_BELOW = 0.5


@dataclass
class Model:
    """Scores of every bucket for every language; ``temperature`` calibrates their softmax."""

    languages: list[str]
    scores: np.ndarray
    temperature: float


def _letters() -> bytes:
    """For each byte itself if it can belong to a letter, else a space."""
    return bytes(b if chr(b).isalpha() and b < 128 or b >= 128 else 32 for b in range(256))


LETTERS = _letters()


def subword_counts(text: str) -> np.ndarray:
    """How often each bucket occurs among the subwords of a whole text."""
    raw = np.frombuffer(
        b" " + text.lower().encode("utf-8", "replace").translate(LETTERS) + b" ", np.uint8
    )
    space = raw == 32
    # one space between words: runs of separators would only add empty subwords
    raw = raw[~(space & np.append(False, space[:-1]))]
    space = raw == 32
    counts = np.zeros(BUCKETS, np.int64)
    code = np.zeros(len(raw), np.uint32)
    inner = np.zeros(len(raw), bool)
    for size in SIZES:
        count = len(raw) - size + 1
        if count <= 0:
            break
        # bytes of the subword as one number; a space inside it spans two words
        code = (code[:count] << np.uint32(8)) | raw[size - 1 :].astype(np.uint32)
        if size > 2:
            inner = inner[:count] | space[size - 2 : size - 2 + count]
        else:
            inner = np.zeros(count, bool)
        alone = space[:count] & space[size - 1 :] if size <= 2 else np.zeros(count, bool)
        good = code[~(inner | alone)]
        with np.errstate(over="ignore"):
            mixed = (good ^ np.uint32(size * 0x1B873593 & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
        counts += np.bincount(mixed >> np.uint32(32 - 14), minlength=BUCKETS)
    return counts


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def training_rows(docs: DataFrame, text: str, lang: str, eligible: Column, key: str) -> DataFrame:
    """A bounded sample of labelled rows as sparse counts, the same in every run.

    Of every language about ``ROWS_PER_LANGUAGE`` rows are taken by a hash of their key, or its
    part of ``ROWS`` where languages are many; all of them where there are no more. Rows that
    share a key share a hash, so the whole sample is held to twice its size.
    """
    labelled = docs.filter(eligible & F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = (
        labelled.groupBy(F.col(lang).alias("_lang"))
        .agg(F.count("*").alias("_rows"))
    )
    languages = sizes.count()
    wanted = max(1, min(ROWS_PER_LANGUAGE, ROWS // max(languages, 1)))
    # uniform in [0, 1)
    place = F.pmod(F.xxhash64(F.col(key), F.lit("language")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = (
        labelled.select(F.col(lang).alias("_lang"), F.col(text).alias("_text"), place.alias("_at"))
        .join(sizes, "_lang")
        .filter(F.col("_at") * F.col("_rows") < wanted)
        .limit(2 * max(ROWS, languages))
        .select("_lang", "_text", "_at")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            places, values = [], []
            for value in part.column(1).to_pylist():
                counts = subword_counts(value)
                at = np.flatnonzero(counts)
                places.append(at.astype(np.int32))
                values.append(counts[at].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(places, pa.list_(pa.int32())),
                 pa.array(values, pa.list_(pa.int32()))],
                ["lang", "at", "places", "counts"],
            )

    return mapped(sample, count, "lang string, at double, places array<int>, counts array<int>")


def train(table: pa.Table, epochs: int = 12, rate: float = 4.0, batch: int = 16) -> Model:
    """Stochastic gradient descent over averaged embeddings, then a temperature that makes the
    probabilities of a fifth of the rows, left out of the descent, meet their accuracy."""
    if table.num_rows:
        # hash places and languages order the rows alike in every run
        keys = [("at", "ascending"), ("lang", "ascending")]
        table = table.filter(pc.greater(pc.list_value_length(table["places"]), 0)).sort_by(keys)
    languages = sorted(set(table["lang"].to_pylist()))
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), 1.0)
    answers = np.array([languages.index(lang) for lang in table["lang"].to_pylist()])
    rows = list(zip(table["places"], table["counts"]))
    held = np.arange(len(rows)) % 5 == 4
    if len(rows) < 20:
        held[:] = False
    dice = np.random.default_rng(0)
    embeddings = dice.normal(0, 0.1, (BUCKETS, WIDTH))
    output = dice.normal(0, 0.1, (WIDTH, len(languages)))
    sparse = []
    for places, counts in rows:
        weights = counts.values.to_numpy().astype(np.float32)
        sparse.append((places.values.to_numpy(), weights / weights.sum()))
    learned = np.flatnonzero(~held)
    steps = epochs * -(-len(learned) // batch)
    step = 0
    for _ in range(epochs):
        for part in np.array_split(dice.permutation(learned), -(-len(learned) // batch)):
            pace = rate * (1 - step / steps)
            step += 1
            means = np.stack([weights @ embeddings[places] for places, weights in (sparse[i] for i in part)])
            gap = _softmax(means @ output)
            gap[np.arange(len(part)), answers[part]] -= 1
            gap /= len(part)
            back = gap @ output.T
            output -= 0.25 * pace * (means.T @ gap)
            for row, i in enumerate(part):
                places, weights = sparse[i]
                # a bucket's share in a text is small: its step is scaled up by the buckets met
                embeddings[places] -= pace * np.outer(np.sqrt(weights) * 4, back[row])
    scores = embeddings @ output
    tried = np.flatnonzero(held) if held.any() else learned
    logits = np.stack([sparse[i][1] @ scores[sparse[i][0]] for i in tried])
    # the mean probability of the best language has to meet the share of right answers, with
    # one right and one wrong answer added so that a faultless sample makes nobody certain
    honest = ((logits.argmax(axis=1) == answers[tried]).sum() + 1) / (len(tried) + 2)
    heats = np.geomspace(0.01, 20, 121)
    gaps = [abs(_softmax(logits / heat).max(axis=1).mean() - honest) for heat in heats]
    return Model(languages, scores.astype(np.float32), float(heats[int(np.argmin(gaps))]))


def _softmax(logits: np.ndarray) -> np.ndarray:
    powers = np.exp(logits - logits.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def predict_texts(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and calibrated probability of each whole text."""
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if not model.languages:
        return names, scores
    for i, text in enumerate(texts):
        if not text or not has_letter(text):
            continue
        counts = subword_counts(text)
        logits = counts.astype(np.float32) @ model.scores / max(counts.sum(), 1)
        chances = _softmax(logits[None, :].astype(float) / model.temperature)[0]
        best = int(np.argmax(chances))
        names[i], scores[i] = model.languages[best], chances[best]
    return names, scores


def identify_language(
    docs: DataFrame,
    eligible: Column,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
) -> DataFrame:
    """All columns of ``docs`` with ``lang_pred``, ``score`` and ``rejected``.

    The model learns from a bounded sample of the rows for which ``eligible`` holds; key and
    language choose and label that sample and are no inputs of a prediction. The whole text
    is read. A null text and one without letters give ``und``, score 0 and a rejection, and so
    does every text when there is no row to learn from. A score under ``REJECT_BELOW``, after
    calibration, is a rejection too. Rows are independent: repeated rows and keys give repeated
    results. Columns called lang_pred, score or rejected give way to the new ones.
    """
    model = train(training_rows(docs, text, lang, eligible, key).toArrow())
    pa.default_memory_pool().release_unused()
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept]
    at = kept.index(text)
    # plain values, as workers need no copy of the library to read them
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = Model(**shared.value)
        for part in slices(batches):
            names, scores = predict_texts(learned, part.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(scores < REJECT_BELOW, pa.bool_())],
                [*kept, "lang_pred", "score", "rejected"],
            )

    schema = ", ".join([*kinds, "lang_pred string", "score double", "rejected boolean"])
    return mapped(docs.select(*kept), predict, schema)


def held_out(key: str = "doc_id") -> Column:
    """The quarter of documents that nothing is learned from; false for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))
