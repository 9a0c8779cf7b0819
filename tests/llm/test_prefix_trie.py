"""The prefix trie against one built from all prefixes in memory."""

import hashlib
import random
import zlib

import pytest

from orelode.llm import prefix_trie
from orelode.llm.prefix_trie import conversation_trie, medians

SCHEMA = "conv_id long, turn long, role string, text string, depth string, key int"


def expected_trie(rows):
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = own.get(c - int(c / abs(c) * (abs(c) % 5)) if c else 0, [])
        path = tuple(base[:h] + turns[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    found = {}

    for path in sorted(members, key=len, reverse=True):
        below = [found[p] for p in children.get(path, [])]
        size = len(path[-1][1].encode()) if path else 0
        found[path] = (
            min(members[path]),
            len(path),
            min(members[path[:-1]]) if path else None,
            len(members[path]),
            len(below),
            sum(b[5] for b in below) if below else 1,
            (len(members[path]) - 1) * size + sum(b[6] for b in below),
            hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest(),
        )
    return sorted(found.values(), key=repr)


def check(spark, rows, partitions=3, ranges=6):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        frame = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
        found = [tuple(r) for r in conversation_trie(frame).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(found, key=repr) == expected_trie(rows)
    return found


def talks(seed, convs, words, longest):
    dice = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(dice.randint(1, longest)):
            role = "user" if turn % 2 == 0 else "assistant"
            rows.append((conv, turn, role, f"{dice.randint(0, words)}é" * dice.randint(1, 2), "x", 1))
    return rows


@pytest.mark.parametrize(("ranges", "adaptive"), [(1, "true"), (23, "false")])
def test_the_trie_is_that_of_all_prefixes(spark, ranges, adaptive):
    rows = talks(1, 150, 2, 12)
    # nulls, ties, repeated rows, turns without a number, negative ids, a conversation without a base
    rows += [(7, 3, None, None, "x", 1)] * 3 + [(8, None, "user", "first", "x", 1), (None, 1, "user", "x", "x", 1)]
    rows += [(-7, t, "user", "0é", "x", 1) for t in range(9)] + [(1003, t, "user", "0é", "x", 1) for t in range(2)]
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, adaptive)
    try:
        check(spark, rows, ranges=ranges)
    finally:
        spark.conf.set(key, before)


def test_long_conversations_go_on_in_lower_trees(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SEGMENT", 3)
    rows = talks(2, 60, 1, 26)
    # copies that part late, and one that ends exactly where it would be cut
    for conv, length in ((500, 40), (505, 40), (510, 39), (515, 33), (520, 12)):
        rows += [(conv, t, "user", "deep" if t < 37 else f"deep {conv}", "x", 1) for t in range(length)]
    check(spark, rows, ranges=9)


def test_a_large_group_of_copies_spans_ranges(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "LIST_IDS", 7)
    rows = [(5 * c, t, "user", f"same {t}", "x", 1) for c in range(300) for t in range(3)]
    rows += [(5 * c, t, "user", f"same {t}", "x", 1) for c in range(300, 340) for t in range(5)]
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        check(spark, rows, ranges=12)
    finally:
        spark.conf.set(key, before)


def test_a_single_conversation_and_none(spark):
    check(spark, [(0, 0, "user", "x", "x", 1)])
    check(spark, [(4, 0, "user", "only", "x", 1)])
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert conversation_trie(spark.createDataFrame([(None, 0, "user", "x", "x", 1)], SCHEMA)).collect() == []


def test_medians_visit_every_place_once_and_halve():
    for count in (0, 1, 2, 7, 100):
        order = list(medians(count))
        assert sorted(order) == list(range(count))
    assert list(medians(7))[0] == 3
