"""Mixing, packing and the pipeline: sums, round trips and stages against brute force."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from corpus_rows import make_docs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from orelode.llm import bm25_packing
from orelode.llm.bm25_packing import PIECE, Ids, Shard, pack_documents, signature
from orelode.llm.common import PLAN_LENGTH, PLAN_SETTING, staged
from orelode.llm.pareto_mix import MOST_COPIES, SHARE, WEIGHTS, mix_sources

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def targets_by_hand(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(order)}
    total, capped = SHARE * sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in capped]
        held = sum(MOST_COPIES * sizes[s] for s in capped)
        unit = (total - held) / sum(weight[s] for s in rest) if rest else 0
        over = {s for s in rest if unit * weight[s] > MOST_COPIES * sizes[s]}
        if not over:
            return {s: MOST_COPIES * sizes[s] if s in capped else unit * weight[s] for s in order}
        capped |= over


def test_mix_meets_its_targets(docs):
    rows = make_docs()
    size = {r: len((r[1] or "").encode().split()) for r in rows}
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size[r]
    expected = targets_by_hand(sizes)
    by_id = {(r[0], r[1]): r for r in rows}
    found = mix_sources(docs).collect()
    assert len(found) == len(rows)
    taken = Counter()
    for row in found:
        own = by_id[row.doc_id, row.text]
        assert (row.source_size, row.taken) == (sizes[own[3]], row.copies * size[own])
        assert row.target == pytest.approx(expected[own[3]])
        assert 0 <= row.taken <= 2 * size[own]
        taken[own[3]] += row.taken
    for source, target in expected.items():
        largest = max(size[r] for r in rows if r[3] == source)
        assert abs(taken[source] - target) <= max(1, min(largest, 0.02 * target))
    again = mix_sources(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_mix_of_nothing(spark, no_docs):
    assert mix_sources(no_docs).collect() == []
    empty = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {(r.doc_id, r.taken, r.target) for r in mix_sources(empty).collect()} == {(1, 0, 0.0), (2, 0, 0.0)}


def test_pareto_inclusion_follows_the_odds(spark):
    rows = [(i, "w " * 4, f"s{i % 2}") for i in range(6000)]
    rows += [(10_000 + i, "w " * 4, "s2") for i in range(600)]
    found = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    low = [r.copies for r in found.filter("source = 's1'").collect()]
    share = targets_by_hand({"s0": 12000, "s1": 12000, "s2": 2400})["s1"] / 12000
    assert np.mean(low) == pytest.approx(share, abs=0.01) and set(low) <= {0, 1}


# ---------------------------------------------------------------- packing


def ids_by_hand(text):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_ids_are_those_of_the_whole_text():
    ids = Ids(TOKENIZER)
    texts = ["", "The cat's MAT### don't 12 x2y é́ ÉCOLE straße İ ΣΑΣ.", "a<|endoftext|>b <|startoftext|>",
             "x y z \U0001f600!", "que###  mit&&&\n~~~ it's,", "''s 's", "the The THE the, ÿ Ÿ ŸŸ the;;"]
    assert [np.frombuffer(raw, ids.kind).tolist() for raw in ids.of(texts)] == [ids_by_hand(t) for t in texts]


def test_words_of_a_batch_are_cut_into_pieces_once(monkeypatch):
    class Counting:
        letters = 0

        def findall(self, text):
            self.letters += len(text)
            return PIECE.findall(text)

    counting = Counting()
    monkeypatch.setattr(bm25_packing, "PIECE", counting)
    text = "The cat's mat, \t\r\n 12 ÉCOLE\n\nthe the; "
    ids = Ids(TOKENIZER)
    found = ids.of([text * 40, text, "\n ", ""])
    assert [np.frombuffer(raw, ids.kind).tolist() for raw in found] == [ids_by_hand(t) for t in (text * 40, text, "\n ", "")]
    assert counting.letters <= 2 * len(text)


def test_long_texts_are_tokenised_in_smaller_parts(monkeypatch):
    monkeypatch.setattr(bm25_packing, "TEXT_BYTES", 100)
    texts = ["a b " * 10, "", None, "c" * 500, "d", "e f " * 30]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6), pa.int64()), pa.array(texts)], ["doc", "text"])
    parts = list(bm25_packing.halved(batch))
    assert [text for part in parts for text in part.column(1).to_pylist()] == texts
    assert all(part.num_rows == 1 or part.column(1).nbytes <= 100 for part in parts) and len(parts) > 2


@pytest.mark.parametrize("window", [2048, 64])
def test_every_id_is_in_one_piece(docs, window):
    rows = make_docs()
    found = pack_documents(docs, TOKENIZER, window=window, with_ids=True).collect()
    texts = defaultdict(list)
    for r in rows:
        texts[r[0]].append(ids_by_hand(r[1]))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length > 0
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert pieces.keys() == texts.keys()
    for key, own in texts.items():
        expected = Counter(i for ids in own for i in ids)
        assert Counter(i for r in pieces[key] for i in r.ids) == expected
        if len(own) == 1:
            whole = [i for r in sorted(pieces[key], key=lambda r: r.start) for i in r.ids]
            assert whole == own[0] and {r.doc_tokens for r in pieces[key]} == {len(own[0])}
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    # one short window at the end of the one shard
    assert sum(sum(r.length for r in own) < window for own in sequences.values()) <= 1


def test_neighbours_share_words(spark):
    topics = [[f"{a}{b}" for b in ("lo", "mi", "ra", "te")] for a in ("ba", "ke", "du", "no")]
    dice = np.random.default_rng(0)
    rows = [(i, " ".join(dice.choice(topics[i % 4], 10))) for i in range(200)]
    found = pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), TOKENIZER, window=128).collect()
    topic = defaultdict(list)
    for r in found:
        topic[r.sequence_id].append(r.doc_id % 4)
    same = sum(Counter(own).most_common(1)[0][1] for own in topic.values()) / len(found)
    assert same > 0.8


def test_all_terms_of_a_seed_ask():
    # a seed's ten rarest terms are its own; the common ones are those of the last document alone
    dice, vocabulary = np.random.default_rng(1), 2000
    texts = [np.r_[1000:1010, 0:5], *(dice.integers(500, 900, 20) for _ in range(300)), np.r_[0:5, 1100:1105]]
    idf = np.full(vocabulary, 1.0)
    idf[1000:] = 9.0
    shard = Shard([(i, ids) for i, ids in enumerate(texts)], idf, 15.0, 64)
    shard.next = 0
    assert next(shard.neighbours(0)) == len(texts) - 1


def test_neighbours_are_in_the_order_of_their_scores():
    dice = np.random.default_rng(2)
    idf = dice.random(50) + 0.1
    texts = [dice.integers(0, 50, dice.integers(5, 30)) for _ in range(400)]
    shard = Shard([(i, ids) for i, ids in enumerate(texts)], idf, 15.0, 64)
    shard.next = 0
    used = dice.permutation(np.arange(1, 400))

    def scores():
        own = set(texts[0].tolist())
        found = {}
        for i, ids in enumerate(texts):
            count = Counter(t for t in ids.tolist() if t in own)
            found[i] = sum(idf[t] * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(ids) / 15.0)) for t, n in count.items())
        return found

    expected = scores()
    for gone in (0, 100, 250):
        shard.left[used[:gone]] = 0
        found = list(dict.fromkeys(shard.neighbours(0)))
        ranked = found[: sum(expected[i] > 0 for i in found)]
        assert all(expected[a] >= expected[b] - 1e-9 for a, b in zip(ranked, ranked[1:]))
        assert set(found) == set(range(1, 400)) - set(used[:gone].tolist())


def test_places_of_documents_do_not_tell_their_length():
    dice = np.random.default_rng(4)
    orders = [dice.permutation(5_000) for _ in range(3)]
    sizes = np.where(np.arange(600) % 3, 30, 1_500)
    marks = [signature(dice.integers(0, 5_000, size), orders[:2], orders[2]) for size in sizes]
    along = sizes[np.argsort([near for near, _ in marks], kind="stable")]
    tenths = along.reshape(10, -1).sum(axis=1)
    assert tenths.max() < 2 * tenths.mean()


def test_driver_does_not_load_the_tokenizer(spark, monkeypatch):
    monkeypatch.setattr("tokenizers.Tokenizer", None)
    rows = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.length) for r in pack_documents(rows, TOKENIZER).collect()) == [(1, 3), (2, 1)]


def test_driver_keeps_short_descriptions_of_written_plans(spark):
    rows = spark.range(10)
    for i in range(60):
        rows = rows.filter(F.col("id") != 100 + i).withColumn("id", F.expr(f"id + rand({i})").cast("long"))
    before = spark.conf.get(PLAN_SETTING)
    staged(rows, "wide")
    assert spark.conf.get(PLAN_SETTING) == before
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    store = spark._jsparkSession.sharedState().statusStore()
    assert len(store.executionsList().last().physicalPlanDescription()) <= PLAN_LENGTH


def test_packing_of_nothing(no_docs):
    assert pack_documents(no_docs, TOKENIZER).collect() == []


# ---------------------------------------------------------------- pipeline


def test_stages_keep_the_columns(spark, docs):
    frame = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = corpus_pipeline.staged(stage(spark, frame, ""), name)
        assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert frame.count() > 0


def test_one_document_of_each_near_group_stays(spark, docs):
    frame = docs.select("doc_id", "text", "lang", "source", "n_chars").filter("doc_id is not null")
    kept = [r.doc_id for r in corpus_pipeline.deduplicated(spark, frame, "").collect()]
    from test_pairs import groups, shingle_set

    sets = {r[0]: shingle_set(r[1], 5) for r in make_docs() if r[0] is not None}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert sorted(kept) == sorted(k for k, v in groups(sets, links).items() if k == v)


def test_private_data_leaves_the_text(spark):
    rows = [(1, "write to a@b.example now", "en", "s", 24), (2, None, None, None, 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r.doc_id: r for r in corpus_pipeline.without_personal_data(spark, frame, "").collect()}
    assert found[1].text == "write to [EMAIL] now" and found[1].n_chars == 20
    assert found[2].text is None


def test_pipeline_packs_what_the_mix_took(spark):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    lengths = found.groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert all(r[1] <= 2048 for r in lengths)
    parts = found.groupBy("doc_id", "start").count().groupBy("doc_id").agg({"count": "max"}).collect()
    assert max(r[1] for r in parts) <= 2


def test_inclusion_is_in_proportion_to_size(spark):
    """Sizes 10 and 30 in one source, a third of its words wanted beside one certain copy; one
    document is so long that it is certain."""
    rows = [(i, "w " * (10 if i % 2 else 30), "b") for i in range(3000)] + [(3000, "w " * 9000, "b")]
    rows += [(4000 + i, "v " * 20, s) for s, n in (("a", 900), ("c", 900)) for i in range(n)]
    found = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    mixed = [r for r in found if r.source == "b"]
    extra = mixed[0].target - mixed[0].source_size * int(mixed[0].target // mixed[0].source_size)
    more = {r.doc_id: r.copies - int(r.target // r.source_size) for r in mixed}
    assert more[3000] == 1
    # 1,500 documents of each size: scale * (10 * 10 + 30 * 30) * 1500 words beside the long one
    scale = (extra - 9000) / (1500 * 1000)
    for size, place in ((10, 1), (30, 0)):
        share = sum(more[i] for i in range(3000) if i % 2 == place) / 1500
        spread = (scale * size * (1 - scale * size) / 1500) ** 0.5
        assert abs(share - scale * size) < 5 * spread, (size, share, scale * size)
    assert abs(sum(r.taken for r in mixed) - mixed[0].target) <= 10
