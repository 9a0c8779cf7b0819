"""Secrets in texts, and weak candidates that are one part of a credential beside another.

Every expression is one of Spark's own; no row passes through Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelode.llm.common import staged

# The base patterns, in the order in which kinds are listed.
BASE = {
    "assign": r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    # the letters of a run are all its own, so its least length can stand in the pattern
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
LEAST_VALUE = 6

#: What may stand before a name, as in DB_USER; the span begins with it. Neither engine's form
#: needs a look-behind.
BEFORE = r"(?:\w*_)?"
#: The same, but not ending in "secret": a secret_access_key is no identifier.
NOT_SECRET = r"(?:(?:\w*(?:[^\Wt]|[^\We]t|[^\Wr]et|[^\Wc]ret|[^\We]cret|[^\Ws]ecret)|e?c?r?e?t)?_)?"
IS = r"[\"']?\x20*[:=]\x20*[\"']?"
#: Parts that mean nothing alone: names with a value, and endpoints. An assignment whose value
#: is too short for a base span, or goes on with other signs, is a part too.
WEAK = {
    "identifier": rf"(?i)\b(?:{BEFORE}(?:client_?id|user(?:_?(?:name|id))?|login|account(?:_?id)?|access_?key_?id)"
    rf"|{NOT_SECRET}access_?key){IS}([A-Za-z0-9._@+-]{{3,}})",
    "credential": rf"(?i)(?:\b{BEFORE}(?:pass(?:_?(?:phrase|code))?|pwd|pin|auth|bearer|access_?secret|credentials?"
    rf"|secret_?(?:access_?)?key|(?:private|signing|encryption|shared|master|account|storage|session|auth)_?key)"
    rf"{IS}[^\s\"'<>]{{4,}}|(?:password|passwd|secret|token|api_?key){IS}[^\s\"'<>]+)",
    "endpoint": rf"(?i)\b{BEFORE}(?:(?:https?|ftps?|sftp|ssh|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqps?)"
    rf"://[^\s\"'<>]{{4,}}|(?:host|hostname|endpoint|server){IS}[A-Za-z0-9.-]+\.[A-Za-z0-9.-]+(?::[0-9]+)?)",
}
KINDS = [*BASE, *WEAK]
#: The role each kind plays, and the roles of which one has to be near for a weak kind.
ROLE = {
    "assign": "secret", "access": "identifier", "hex": "secret",
    "identifier": "identifier", "credential": "secret", "endpoint": "endpoint",
}
COMPLEMENT = {
    "identifier": ["secret"],
    "credential": ["identifier", "endpoint"],
    "endpoint": ["secret"],
}
#: Code points around a part that make its scope, and the width of a bin of the interval join.
SCOPE = 200
BIN = 512

#: Matches that are put together at a time: appending to a list copies it.
TOGETHER = 256

SPAN = "array<struct<start:int,stop:int,kind:int,value:string>>"


def matches(text: Column, pattern: str, kind: int) -> Column:
    """Leftmost non-overlapping matches with their places in code points.

    The pieces between matches and the matches alternate, so their lengths add up to places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    steps = F.zip_with(
        F.slice(pieces, F.lit(1), F.size(found)),
        found,
        lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(state: Column, one: Column) -> Column:
        begin = state["at"] + one["gap"]
        stop = begin + F.length(one["value"])
        span = F.struct(
            begin.alias("start"), stop.alias("stop"), F.lit(kind).alias("kind"),
            one["value"].alias("value"),
        )
        return F.struct(stop.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    # runs of steps with the place where each begins, then the spans of each run
    count = F.size(found)
    firsts = F.sequence(F.lit(0), F.floor((count - 1) / TOGETHER).cast("int"))
    runs = F.transform(firsts, lambda k: F.slice(steps, k * TOGETHER + 1, F.lit(TOGETHER)))
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    begins = F.aggregate(
        runs,
        none,
        lambda state, run: F.struct(
            F.aggregate(run, state["at"], lambda at, one: at + one["gap"] + F.length(one["value"])).alias("at"),
            F.concat(state["out"], F.array(state["at"])).alias("out"),
        ),
        lambda state: state["out"],
    )
    spans = F.flatten(
        F.zip_with(
            runs,
            begins,
            lambda run, begin: F.aggregate(
                run, F.struct(begin.alias("at"), start["out"].alias("out")), step, lambda state: state["out"]
            ),
        )
    )
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(SPAN))


def listed(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    parts = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string")
        ),
    )
    return F.array_join(parts, ",")


def of_kind(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def order_keys(spans: Column) -> Column:
    """Spans with the fields that order them first."""
    return F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"))
    )


def find_credentials(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_assign, n_access, n_hex, base_sha256, spans, found`` for every row of ``docs``.

    Base spans stand for themselves. A weak candidate (a named identifier, a named secret that
    is no base span, an endpoint) is reported when a part that complements it lies within ``SCOPE`` code points in
    the same text, and when it doesn't overlap a base span. The search for partners is an
    interval join on bins of the text, which asks only whether one exists, so a text full of
    parts is spread over its bins and makes no pairs. ``found`` has the spans with their values.

    A null or empty text has no spans and the digest of the empty string. Rows are told apart by
    key and text; equal rows get equal results, null keys included. No other column is read.
    An empty table gives no rows.
    """
    code = F.xxhash64(F.col(text))
    value = F.coalesce(F.col(text), F.lit(""))
    base = [matches(value, pattern, i) for i, pattern in enumerate(BASE.values())]
    base[0] = F.filter(
        base[0], lambda s: F.length(F.regexp_extract(s["value"], BASE["assign"], 1)) >= LEAST_VALUE
    )
    weak = [matches(value, pattern, len(BASE) + i) for i, pattern in enumerate(WEAK.values())]
    scanned = docs.select(
        F.col(key).alias("_key"),
        code.alias("_code"),
        F.concat(*base).alias("_base"),
        F.concat(*weak).alias("_weak"),
    )
    scanned = staged(scanned, "credentials")
    clear = F.filter(
        F.col("_weak"),
        lambda w: ~F.exists(F.col("_base"), lambda b: (b["start"] < w["stop"]) & (w["start"] < b["stop"])),
    )
    weak_rows = scanned.filter(F.size("_weak") > 0).withColumn("_weak", clear)
    linked = linked_parts(weak_rows)
    result = scanned.join(
        linked.toDF("_k", "_c", "_linked"),
        F.col("_key").eqNullSafe(F.col("_k")) & F.col("_code").eqNullSafe(F.col("_c")),
        "left",
    )
    spans = F.concat("_base", F.coalesce("_linked", F.array().cast(SPAN)))
    counts = [of_kind(F.col("_base"), i).alias(f"n_{name}") for i, name in enumerate(BASE)]
    return result.select(
        F.col("_key").alias(key),
        *counts,
        F.sha2(listed(order_keys(F.col("_base"))).cast("binary"), 256).alias("base_sha256"),
        listed(order_keys(spans)).alias("spans"),
        F.transform(
            spans,
            lambda s: F.struct(
                F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1).alias("kind"),
                s["start"].alias("start"), s["stop"].alias("stop"), s["value"].alias("value"),
            ),
        ).alias("found"),
    )


def linked_parts(rows: DataFrame) -> DataFrame:
    """``_key, _code, spans``: the weak parts of each text that have a partner in their scope."""
    roles = F.array(*[F.lit(ROLE[kind]) for kind in KINDS])
    parts = rows.dropDuplicates(["_key", "_code"])
    part = F.explode(F.concat("_base", "_weak")).alias("s")
    partner = parts.select("_key", "_code", part).select(
        F.col("_key").alias("_k"),
        F.col("_code").alias("_c"),
        F.col("s.start").alias("_from"),
        F.col("s.stop").alias("_to"),
        F.element_at(roles, F.col("s.kind") + 1).alias("_role"),
        F.explode(bins(F.col("s.start"), F.col("s.stop"))).alias("_b"),
    )
    wanted = F.create_map(
        *[x for kind, near in COMPLEMENT.items() for x in (F.lit(KINDS.index(kind)), F.array(*map(F.lit, near)))]
    )
    seeking = parts.select("_key", "_code", F.explode("_weak").alias("s")).select(
        "_key",
        "_code",
        "s",
        F.element_at(wanted, F.col("s.kind")).alias("_wants"),
        F.explode(bins(F.col("s.start") - SCOPE, F.col("s.stop") + SCOPE)).alias("_bin"),
    )
    near = (
        F.col("_key").eqNullSafe(F.col("_k"))
        & (F.col("_code") == F.col("_c"))
        & (F.col("_bin") == F.col("_b"))
        & (F.col("_from") < F.col("s.stop") + SCOPE)
        & (F.col("_to") > F.col("s.start") - SCOPE)
        & F.array_contains(F.col("_wants"), F.col("_role"))
    )
    found = seeking.join(partner, near, "left_semi")
    return (
        found.select("_key", "_code", "s").distinct().groupBy("_key", "_code").agg(F.collect_list("s").alias("spans"))
    )


def bins(start: Column, stop: Column) -> Column:
    first = F.floor(F.greatest(start, F.lit(0)) / BIN)
    return F.sequence(first, F.floor(F.greatest(stop, F.lit(0)) / BIN))
