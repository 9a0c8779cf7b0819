"""The prefix trie of conversations, with what training saves by reading shared turns once."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelode.llm.common import discard, mapped, staged
from orelode.llm.turns import placed_turns
from orelode.operators.lookup import lookup

#: A conversation is cut into segments of so many turns: no row and no group holds more of it.
SEGMENT = 64
#: A rebuilt conversation begins with at most so many turns of another one ...
HEAD_TURNS = 8
#: ... which is the one whose id is the next lower multiple of this.
FAMILY = 5
#: Conversation ids in one text of a list that is read across tasks.
LIST_IDS = 65_536

SEGMENTS = "seg int, grp binary, up binary, nxt binary, conv long, ids array<long>, sizes array<long>"
PARTS = (
    "kind int, key binary, parent_key binary, depth long, conv long, parent long, members long, size long, "
    "children long, leaves long, saved long, goes_on boolean, ends string"
)
INNER, EDGE, LIST = 0, 1, 2


def conversation_trie(rows: DataFrame, **columns: str) -> DataFrame:
    """The trie of the rebuilt conversations, one row for each of its nodes.

    Conversation c is rebuilt from the first h turns of conversation c - c % 5 (all if it has fewer,
    none if there is no such conversation) and its own turns after its first h, h being the CRC-32
    of its id in decimal, modulo 9; % takes the sign of c. Turns are ordered as in ``placed_turns``,
    which says what nulls and repeated rows give; rows without a conversation are left out, other
    columns ignored. Two turns are equal when role and text are. An empty table has no nodes.

    Turns become numbers by a dictionary. The sequences are dealt by ranges of their order, and each
    range builds a ternary search tree; nodes that other ranges may hold as well, which lie on the
    first or the last path of a range, are merged afterwards. That is at most twice ``SEGMENT`` rows
    a range, the only rows the driver sees. Conversations of more than ``SEGMENT`` turns go on in a
    tree below the node where they were cut; its totals are added at the cut. Ids that end at one
    node are hashed in the task that holds them, or, across ranges, in one pass over lists of them.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    """
    known = rows.filter(F.col(columns.get("conv", "conv_id")).isNotNull())
    segments = staged(cut(rebuilt(coded(placed_turns(known, **columns)))), "segments")
    none = F.lit(0).cast("long")
    plain = segments.withColumns({"more_children": none, "more_leaves": none, "more_saved": none})
    if not segments.filter("seg > 0").isEmpty():
        plain = with_lower_trees(segments, plain)
    nodes = trie_nodes(plain)

    named = nodes.filter(F.col("key").isNotNull()).select(F.col("key").alias("named"), F.col("conv").alias("above"))
    named = staged(named, "named")
    nodes = lookup(nodes, named, "parent_key", "named")
    return nodes.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.coalesce("parent", "above").alias("parent_conv_id"),
        F.col("members").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )


# --- from turns to sequences ---------------------------------------------------------------


def coded(turns: DataFrame) -> DataFrame:
    """``conv, index, id, size``: turns as numbers of a dictionary, with the bytes of their texts.

    The dictionary holds the SHA-256 of role and text instead of these. A turn that very many
    conversations share is a hot key of the join, which ``lookup`` spreads.
    """
    named = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    keyed = turns.select(
        F.col("conv_id").alias("conv"),
        "index",
        F.unhex(F.sha2(named, 256)).alias("turn"),
        F.octet_length("text").cast("long").alias("size"),
    )
    keyed = staged(keyed, "keyed")
    words = keyed.select(F.col("turn").alias("word")).distinct().withColumn("id", F.monotonically_increasing_id())
    words = staged(words, "words")
    found = staged(lookup(keyed, words, "turn", "word").select("conv", "index", "id", "size"), "coded")
    discard(keyed, words)
    return found


def rebuilt(turns: DataFrame) -> DataFrame:
    """``conv, place, id, size`` of the rebuilt conversations, and a row without an id for each.

    A conversation gives its head to at most ``FAMILY`` others, so the join has no hot key. Where
    the head is shorter than h, the conversation's own turns move up by the gap.
    """
    taken = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(HEAD_TURNS + 1))
    heads = turns.filter(F.col("index") < HEAD_TURNS).select(F.col("conv").alias("b"), "index", "id", "size")
    ids = turns.select("conv").distinct().withColumn("h", taken)
    ids = staged(ids.withColumn("base", F.col("conv") - F.col("conv") % FAMILY), "ids")
    lengths = heads.groupBy(F.col("b").alias("base")).agg(F.count("*").alias("n"))
    gap = F.col("h") - F.coalesce("n", F.lit(0))
    gaps = ids.join(lengths, "base", "left").filter(gap > 0).select(F.col("conv").alias("c"), gap.alias("gap"))
    gaps = staged(gaps, "gaps")

    borrowed = ids.join(heads, F.col("base") == F.col("b")).filter(F.col("index") < F.col("h"))
    own = lookup(turns.filter(F.col("index") >= taken), gaps, "conv", "c")
    place = F.col("index") - F.coalesce("gap", F.lit(0))
    nothing = F.lit(None).cast("long")
    return (
        own.select("conv", place.alias("place"), "id", "size")
        .unionByName(borrowed.select("conv", F.col("index").alias("place"), "id", "size"))
        .unionByName(ids.select("conv", F.lit(0).cast("long").alias("place"), nothing.alias("id"), nothing.alias("size")))
    )


def cut(turns: DataFrame) -> DataFrame:
    """Sequences in segments of ``SEGMENT`` turns. ``grp`` stands for the turns before a segment,
    ``up`` for those before the segment above, ``nxt`` for those up to its end if it goes on."""
    known = F.filter(F.collect_list(F.struct("place", "id", "size")), lambda t: t["id"].isNotNull())
    segments = (
        turns.groupBy("conv", F.floor(F.col("place") / SEGMENT).cast("int").alias("seg"))
        .agg(F.array_sort(known).alias("turns"))
        .select("seg", "conv", F.col("turns.id").alias("ids"), F.col("turns.size").alias("sizes"))
    )
    segments = staged(segments, "cut")
    alone = (F.col("seg") == 0) & (F.size("ids") < SEGMENT)
    no = F.lit(None).cast("binary")
    short = segments.filter(alone).select("seg", F.lit(b"").alias("grp"), no.alias("up"), no.alias("nxt"), "conv", "ids", "sizes")
    long = segments.filter(~alone).repartition("conv").sortWithinPartitions("conv", "seg")
    return short.unionByName(mapped(long.select("seg", "conv", "ids", "sizes"), chain_rows, SEGMENTS))


def chained(key: bytes, ids) -> bytes:
    """The key of a sequence, from that of its beginning and the turns that follow."""
    for turn in ids:
        key = hashlib.blake2b(key + int(turn).to_bytes(8, "big"), digest_size=16).digest()
    return key


def chain_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys along each conversation, whose segments come in order. A segment is given out when the
    next one tells whether it goes on."""
    names = [f.split()[0] for f in SEGMENTS.split(", ")]
    schema = pa.schema(
        [("seg", pa.int32()), *[(n, pa.binary()) for n in ("grp", "up", "nxt")], ("conv", pa.int64()),
         ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64()))]
    )
    waiting, ahead = None, None
    for batch in batches:
        done = []
        for seg, conv, ids, sizes in zip(*(c.to_pylist() for c in batch.columns)):
            goes_on = waiting is not None and waiting["conv"] == conv
            if waiting is not None:
                done.append({**waiting, "nxt": ahead if goes_on else None})
            waiting = {
                "seg": seg, "grp": ahead if goes_on else b"", "up": waiting["grp"] if goes_on else None,
                "conv": conv, "ids": ids, "sizes": sizes,
            }
            ahead = chained(waiting["grp"], ids)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema).select(names)
    if waiting is not None:
        yield pa.RecordBatch.from_pylist([{**waiting, "nxt": None}], schema).select(names)


# --- from sequences to nodes ---------------------------------------------------------------


def trie_nodes(segments: DataFrame) -> DataFrame:
    """All nodes of the trees over ``segments``. ``key`` names nodes that rows of other ranges or
    segments refer to, ``parent_key`` a parent whose smallest member is not known in the range."""
    order = ["seg", "grp", "ids", "conv"]
    ranges = segments.drop("up").repartitionByRange(*order).sortWithinPartitions(*order)
    parts = staged(mapped(ranges, trie_rows, PARTS), "parts")
    edges = parts.filter(F.col("kind") == EDGE).drop("kind", "parent", "ends").toArrow().to_pylist()
    merged = parts.sparkSession.createDataFrame(
        merge_edges(edges),
        "key binary, parent_key binary, depth long, conv long, members long, children long, leaves long, saved long",
    )
    lists = parts.filter(F.col("kind") == LIST).select("key", "conv", "ends")
    lists = lists.repartition("key").sortWithinPartitions("key", "conv")
    digests = mapped(lists, list_rows, "k binary, ends string")
    merged = merged.join(digests, F.col("key") == F.col("k"), "left").drop("k")
    empty = F.lit(hashlib.sha256().hexdigest())
    merged = merged.withColumns({"ends": F.coalesce("ends", empty), "parent": F.lit(None).cast("long")})
    inner = parts.filter(F.col("kind") == INNER).select(*merged.columns)
    return inner.unionByName(merged)


def with_lower_trees(segments: DataFrame, plain: DataFrame) -> DataFrame:
    """``plain`` with the totals of everything below a cut, on one of the segments that end there.

    Each lower tree first counts what lies in its own segment. Totals then climb from tree to tree,
    twice as far in every round, so the number of rounds is the logarithm of the longest chain.
    """
    lower = plain.filter("seg > 0")
    first = trie_nodes(lower).filter(F.col("depth") % SEGMENT == 1).groupBy(F.col("parent_key").alias("grp"))
    own = first.agg(
        F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )
    trees = lower.groupBy("grp").agg(F.first("seg").alias("seg"), F.first("up").alias("up"), F.min("conv").alias("conv"))
    trees = staged(trees.join(own, "grp"), "trees")
    most = trees.agg(F.max("seg")).first()[0]
    # the tree above the first cut is the root's, which takes the sums at its end nodes
    far = F.when(F.col("seg") > 1, F.col("up"))
    sums = staged(trees.select("grp", far.alias("far"), "leaves", "saved"), "sums")
    reach = 1
    while reach < most:
        given = sums.filter("far is not null").groupBy(F.col("far").alias("g"))
        given = given.agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        next_far = sums.select(F.col("grp").alias("f"), F.col("far").alias("further"))
        climbed = (
            sums.join(given, F.col("grp") == F.col("g"), "left")
            .join(next_far, F.col("far") == F.col("f"), "left")
            .select(
                "grp",
                F.col("further").alias("far"),
                (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"),
            )
        )
        climbed = staged(climbed, "sums")
        discard(sums)
        sums, reach = climbed, reach * 2
    more = trees.select("grp", "conv", (F.col("seg") - 1).alias("seg"), F.col("children").alias("more_children"))
    more = more.join(sums.select("grp", F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved")), "grp")
    more = more.drop("grp")
    names = ["more_children", "more_leaves", "more_saved"]
    found = segments.join(more, ["conv", "seg"], "left")
    return found.withColumns({name: F.coalesce(name, F.lit(0)) for name in names}).select(*plain.columns)


def merge_edges(edges: list[dict]) -> list[tuple]:
    """Nodes that several ranges hold: their parts added up, from the deepest to the root."""
    nodes = {}
    for edge in edges:
        node = nodes.setdefault(edge["key"], edge)
        if node is not edge:
            node["conv"] = min(node["conv"], edge["conv"])
            node["goes_on"] = node["goes_on"] or edge["goes_on"]
            for name in ("members", "children", "leaves", "saved"):
                node[name] += edge[name]
    found = []
    for node in sorted(nodes.values(), key=lambda n: -n["depth"]):
        leaf = not node["children"] and not node["goes_on"]
        leaves = node["leaves"] + leaf
        saved = node["saved"] + (node["members"] - 1) * node["size"]
        above = nodes.get(node["parent_key"])
        # across a cut the totals are there already
        if above is not None and above["depth"] % SEGMENT != 0 or node["depth"] == 1:
            above["children"] += 1
            above["leaves"] += leaves
            above["saved"] += saved
        found.append(
            (node["key"], node["parent_key"], node["depth"], node["conv"], node["members"], node["children"], leaves, saved)
        )
    return found


# --- inside tasks -----------------------------------------------------------------------------


def list_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for the lists of ids of each node, which come in order."""
    now, digest = None, None
    for batch in batches:
        done = []
        for key, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if key != now:
                if now is not None:
                    done.append({"k": now, "ends": digest.hexdigest()})
                now, digest = key, hashlib.sha256()
                digest.update(ids.encode())
            else:
                digest.update(f",{ids}".encode())
        if done:
            yield pa.RecordBatch.from_pylist(done)
    if now is not None:
        yield pa.RecordBatch.from_pylist([{"k": now, "ends": digest.hexdigest()}])


def medians(count: int) -> Iterator[int]:
    """Places 0..count-1, the middle first, then those of either half in the same way."""
    spans = [(0, count)]
    while spans:
        low, high = spans.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            spans += [(middle + 1, high), (low, middle)]


def trie_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    rows = pa.Table.from_batches(parts).combine_chunks()
    keys = list(zip(rows.column("seg").to_pylist(), rows.column("grp").to_pylist()))
    begins = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
    for start, stop in zip(begins, [*begins[1:], len(keys)]):
        tree = Tree(rows.slice(start, stop - start), *keys[start])
        yield from tree.rows(first=start == 0, final=stop == len(keys))


class Tree:
    """A ternary search tree over the sequences of one segment that lie in one range.

    Node 0 is the node above. Every other one stands for a turn: ``links`` holds its lower and
    higher sibling and the tree of the turns that follow it, ``up`` the turn before it.
    """

    def __init__(self, rows: pa.Table, seg: int, grp: bytes):
        self.seg, self.grp = seg, grp
        self.convs = rows.column("conv").to_numpy()
        lists, sizes = (rows.column(n).combine_chunks() for n in ("ids", "sizes"))
        offsets = lists.offsets.to_numpy()
        ids, lengths = lists.values.to_numpy(), np.diff(offsets)
        size_offsets, bytes_of = sizes.offsets.to_numpy(), sizes.values.to_numpy()
        spelled = [ids[offsets[i] : offsets[i + 1]].tobytes() for i in range(len(lengths))]
        self.starts = [i for i in range(len(spelled)) if i == 0 or spelled[i] != spelled[i - 1]]
        self.stops = [*self.starts[1:], len(spelled)]
        more = [rows.column(n).to_numpy() for n in ("more_children", "more_leaves", "more_saved")]
        goes_on = ~np.asarray(rows.column("nxt").is_null())
        following = rows.column("nxt")

        self.symbol, self.links, self.up = array("q", [0]), array("q", [0, 0, 0]), array("q", [0])
        self.size, self.level = array("q", [0]), array("q", [0])
        self.ends: dict[int, int] = {}
        self.next_key: dict[int, bytes] = {}
        for run in medians(len(self.starts)):
            row = self.starts[run]
            self.insert(
                run, ids[offsets[row] : offsets[row + 1]].tolist(),
                bytes_of[size_offsets[row] : size_offsets[row + 1]].tolist(),
            )
        count = len(self.symbol)
        self.members, self.conv = np.zeros(count, np.int64), np.full(count, np.iinfo(np.int64).max)
        self.children, self.leaves, self.saved = (np.zeros(count, np.int64) for _ in range(3))
        self.goes_on = np.zeros(count, bool)
        self.listed: dict[int, np.ndarray] = {}
        for run, node in self.ends.items():
            here = slice(self.starts[run], self.stops[run])
            self.members[node] = here.stop - here.start
            self.conv[node] = self.convs[here].min()
            self.children[node], self.leaves[node], self.saved[node] = (int(m[here].sum()) for m in more)
            going = goes_on[here]
            if going.any():
                self.goes_on[node] = True
                self.next_key[node] = following[here.start + int(going.argmax())].as_py()
            self.listed[node] = self.convs[here][~going]

    def insert(self, run: int, ids: list[int], sizes: list[int]) -> None:
        symbol, links, node, slot = self.symbol, self.links, 0, 2
        for level, turn in enumerate(ids, 1):
            found = links[slot]
            while found and symbol[found] != turn:
                slot = 3 * found + (turn > symbol[found])
                found = links[slot]
            if not found:
                found = links[slot] = len(symbol)
                symbol.append(turn)
                links.extend((0, 0, 0))
                self.up.append(node)
                self.size.append(sizes[level - 1])
                self.level.append(level)
            node, slot = found, 3 * found + 2
        self.ends[run] = node

    def path(self, run: int) -> list[int]:
        """The nodes from the one above to the end of a sequence."""
        nodes = [self.ends[run]]
        while nodes[-1]:
            nodes.append(self.up[nodes[-1]])
        return nodes[::-1]

    def rows(self, first: bool, final: bool) -> Iterator[pa.RecordBatch]:
        """Nodes that only this range holds, with their totals, and parts of the others."""
        shared = {0: self.grp}
        for run, wanted in ((0, first), (len(self.starts) - 1, final)):
            key = self.grp
            for node in self.path(run)[1:] if wanted else ():
                shared[node] = key = chained(key, [self.symbol[node]])
        up, size = self.up, self.size
        # a node comes after the turn before it, so one walk backwards carries all totals up
        for node in range(len(up) - 1, 0, -1):
            above = up[node]
            self.members[above] += self.members[node]
            self.conv[above] = min(self.conv[above], self.conv[node])
            if node in shared:
                continue
            if not self.children[node] and not self.goes_on[node]:
                self.leaves[node] = 1
            self.saved[node] += (self.members[node] - 1) * size[node]
            self.children[above] += 1
            self.leaves[above] += self.leaves[node]
            self.saved[above] += self.saved[node]
        yield from self.batches(shared)

    def batches(self, shared: dict[int, bytes], most: int = 20_000) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("kind", pa.int32()), ("key", pa.binary()), ("parent_key", pa.binary()),
             *[(n, pa.int64()) for n in "depth conv parent members size children leaves saved".split()],
             ("goes_on", pa.bool_()), ("ends", pa.string())]
        )
        empty = hashlib.sha256().hexdigest()
        done = []
        for node in range(1 if self.seg else 0, len(self.up)):
            above, edge = self.up[node], node in shared
            known = node != 0 and above not in shared
            ids = self.listed.get(node, ())
            ends = empty
            if edge:
                ends = None
                for start in range(0, len(ids), LIST_IDS):
                    text = ",".join(map(str, ids[start : start + LIST_IDS].tolist()))
                    done.append({"kind": LIST, "key": shared[node], "conv": int(ids[start]), "ends": text})
            elif len(ids):
                ends = hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()
            done.append(
                {
                    "kind": EDGE if edge else INNER,
                    "key": shared[node] if edge else self.next_key.get(node),
                    "parent_key": None if known or (node == 0) else shared[above],
                    "depth": self.seg * SEGMENT + self.level[node],
                    "conv": int(self.conv[node]),
                    "parent": int(self.conv[above]) if known else None,
                    "members": int(self.members[node]),
                    "size": self.size[node],
                    "children": int(self.children[node]),
                    "leaves": int(self.leaves[node]),
                    "saved": int(self.saved[node]),
                    "goes_on": bool(self.goes_on[node]),
                    "ends": ends,
                }
            )
            if len(done) >= most:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
