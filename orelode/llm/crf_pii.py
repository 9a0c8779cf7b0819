"""Personal data in texts: fixed patterns, and a linear-chain conditional random field."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from orelode.llm.common import mapped, slices

# The kinds in the order in which they are listed, and their patterns.
KINDS = ["email", "ip", "card", "phone"]
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a run of digits that fails at its start fails further on too
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

TAGS = ["O"] + [f"{part}-{kind}" for kind in KINDS for part in "BI"]
#: Buckets of hashed features, and steps of the training.
BUCKETS = 1 << 12
STEPS = 160
#: Tokens that are decoded together, padding included: lines of similar length side by side.
CELLS = 50_000

#: Words that tell a token's neighbours apart; all other words of letters look alike.
CUES = {
    "phone": "tel", "tel": "tel", "telephone": "tel", "mobile": "tel", "call": "tel", "fax": "tel",
    "cell": "tel", "dial": "tel", "whatsapp": "tel", "telefon": "tel", "téléphone": "tel",
    "teléfono": "tel", "mail": "mail", "email": "mail", "e-mail": "mail", "card": "card",
    "visa": "card", "mastercard": "card", "amex": "card", "credit": "card", "ip": "ip",
    "address": "ip", "host": "ip", "(at)": "at", "[at]": "at", "{at}": "at", "(dot)": "dot",
    "[dot]": "dot", "{dot}": "dot",
}
#: What a line needs for the field to look at it: without it, all of its tokens are words.
HINT = re.compile(r"[0-9@]|[\[({](?:at|dot)[\])}]", re.IGNORECASE)
EDGES = "\"'“”‘’«»<>,;:!?.()[]{}"


# ---------------------------------------------------------------- fixed patterns


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from each @ so
    that long runs of letters cost no more than their length."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1)
        if start < at and domain:
            found.append((start, domain.end()))
            free = domain.end()
        else:
            free = at + 1
        at = text.find("@", free)
    return found


def luhn(digits: str) -> bool:
    twice = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in twice)) % 10 == 0


def small_parts(match: str) -> bool:
    parts = [part.lstrip("0") for part in match.split(".")]
    return all(len(part) <= 3 and int(part or 0) <= 255 for part in parts)


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, stop) of every match that holds, by start and kind."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if small_parts(m[0]):
                found.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = digits_of(m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        for m in PHONE.finditer(text):
            if 10 <= len(digits_of(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{stop}" for start, kind, stop in spans)


# ---------------------------------------------------------------- features


def shape(token: str) -> str:
    """Letters as x, digits as 9, runs of one sign cut at four; the rest as it is."""
    signs = ["9" if c.isdigit() else "x" if c.isalpha() else c for c in token]
    out: list[str] = []
    for sign in signs:
        if len(out) < 4 or out[-4:] != [sign] * 4:
            out.append(sign)
    return "".join(out[:24])


def features(token: str) -> list[str]:
    core = token.strip(EDGES) or token
    cue = CUES.get(token.lower().strip("\"',;:!?.")) or CUES.get(core.lower())
    if cue:
        return ["cue=" + cue]
    if not HINT.search(token):
        return ["word"]
    digits = sum(c.isdigit() for c in core)
    kept = shape(core)
    return [
        "shape=" + kept,
        "brief=" + re.sub(r"(.)\1+", r"\1", kept),
        "marks=" + re.sub(r"[x9]+", "", kept)[:8],
        f"digits={min(digits, 20)}",
        f"mixed={any(c.isalpha() for c in core)}",
        f"at={core.count('@')}",
        f"plus={token.startswith('+') or token.startswith('(+')}",
        f"round={token.startswith('(')}{token.rstrip('.,;').endswith(')')}",
    ]


def bucket(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=4).digest()) % BUCKETS


def token_buckets(tokens: list[str], known: dict) -> list[list[int]]:
    """Buckets of each token: its own features, and those of the tokens beside it."""
    own = []
    for token in tokens:
        found = known.get(token)
        if found is None:
            names = features(token)
            found = [[bucket(f"{place}{name}") for name in names] for place in "=<>"]
            if len(known) < 100_000:
                known[token] = found
        own.append(found)
    edge = [[], [bucket("<edge")], [bucket(">edge")]]
    return [
        own[i][0]
        + (own[i - 1] if i else edge)[1]
        + (own[i + 1] if i + 1 < len(own) else edge)[2]
        for i in range(len(own))
    ]


# ---------------------------------------------------------------- training table


def labelled_lines(count: int = 700, seed: int = 11) -> list[tuple[list[str], list[str]]]:
    """A small table of invented lines with a tag for each token.

    Personal data stands in it in the ways that the fixed patterns miss: phone numbers without a
    plus, addresses written around filters, grouped card numbers; and numbers that are no
    personal data: dates, versions, prices, amounts, codes.
    """
    dice = np.random.default_rng(seed)

    def pick(values):
        return values[int(dice.integers(len(values)))]

    def number(size: int) -> str:
        return "".join(str(int(d)) for d in [dice.integers(1, 10), *dice.integers(0, 10, size - 1)])

    def word() -> str:
        parts = ["an", "the", "er", "on", "re", "es", "tion", "lich", "eau", "ción", "ver", "or", "ing", "que"]
        text = "".join(pick(parts) for _ in range(int(dice.integers(1, 4))))
        return text.capitalize() if dice.random() < 0.15 else text

    def words(most: int) -> list[str]:
        return [word() for _ in range(int(dice.integers(0, most + 1)))]

    def phone() -> list[str]:
        a, b, c = number(3), number(3), number(4)
        return pick([[f"({a})", f"{b}-{c}"], [f"{a}-{b}-{c}"], [f"{a}.{b}.{c}"], [a, b, c],
                     [f"+{number(1)}", f"({a})", f"{b}-{c}"], [f"0{number(3)}/{number(7)}"],
                     [f"+{number(2)}", number(1), *[number(2) for _ in range(4)]],
                     [f"0{number(1)}", *[number(2) for _ in range(4)]]])

    def email() -> list[str]:
        name = pick([word(), f"{word()}.{number(2)}", f"{word()}_{word()}"]).lower()
        host = pick([f"{word()}{number(1)}", word()]).lower()
        return pick([[f"{name}@{host}.{word()}.com".lower()], [f"{name}@{host}.org"],
                     [name, "[at]", host, "[dot]", "com"], [name, "(at)", f"{host}.com"],
                     [name, "(at)", host, "(dot)", "net"], [f"{name}[at]{host}[dot]com"]])

    def card() -> list[str]:
        groups = [number(4) for _ in range(4)]
        return pick([groups, ["-".join(groups)], [number(16)], [number(4), number(6), number(5)]])

    def ip() -> list[str]:
        return [".".join(str(int(x)) for x in dice.integers(1, 255, 4))]

    def other() -> list[str]:
        return pick([[f"20{number(2)}-0{number(1)}-1{number(1)}"], [f"1{number(1)}.0{number(1)}.20{number(2)}"],
                     [f"{number(1)}.{number(1)}"], [f"v{number(1)}.{number(2)}.{number(1)}"], [f"${number(3)}.{number(2)}"],
                     [number(int(dice.integers(1, 8)))], [f"{number(2)}%"], [f"{number(1)},{number(3)}"],
                     [f"{number(2)}:{number(2)}"], [f"{word()}{number(3)}"], [f"#{number(5)}"], [f"@{word()}"],
                     [f"password={number(3)}b{number(4)}f{number(2)}"], ["token", "=", f"\"{number(4)}c{number(6)}a{number(3)}\""],
                     [f"AKIA{number(3)}XK{number(2)}QP{number(4)}ZT"], [f"{number(3)}", f"{number(3)}"], [f"19{number(2)}-20{number(2)}"],
                     [f"({number(4)})"], [f"[{number(1)}]"], [f"{number(1)}/{number(2)}"], [f"ISO-{number(4)}"],
                     [f"{number(3)}-{number(1)}-{number(2)}-{number(6)}-{number(1)}"], [f"{number(8)}"], [f"{number(12)}"]])

    cues = {"phone": ["phone:", "tel.", "call", "mobile"], "email": ["email:", "mail"], "card": ["card", "visa"], "ip": ["ip", "host"]}
    lines = []
    for _ in range(count):
        tokens, tags = [], []
        for _ in range(int(dice.integers(1, 4))):
            before = words(4)
            tokens += before
            tags += ["O"] * len(before)
            if dice.random() < 0.45:
                found = other()
                tokens += found
                tags += ["O"] * len(found)
                continue
            kind = pick(KINDS)
            if dice.random() < 0.3:
                tokens.append(pick(cues[kind]))
                tags.append("O")
            found = {"phone": phone, "email": email, "card": card, "ip": ip}[kind]()
            tags += [f"B-{kind}"] + [f"I-{kind}"] * (len(found) - 1)
            if dice.random() < 0.2:
                found = [*found[:-1], found[-1] + pick([".", ",", ";"])]
            tokens += found
        after = words(3)
        lines.append((tokens + after, tags + ["O"] * len(after)))
    return lines


# ---------------------------------------------------------------- the field


@dataclass
class Field:
    """Weights of features for every tag, of steps between tags, and of tags at the start."""

    emission: np.ndarray
    step: np.ndarray
    start: np.ndarray


def allowed_steps() -> np.ndarray:
    """0 where a tag may follow another, a large loss where it may not: I follows its own kind."""
    loss = np.zeros((len(TAGS), len(TAGS)))
    for a, before in enumerate(TAGS):
        for b, tag in enumerate(TAGS):
            if tag[0] == "I" and before[2:] != tag[2:]:
                loss[a, b] = -1e4
    return loss


def allowed_start() -> np.ndarray:
    return np.array([-1e4 if tag[0] == "I" else 0.0 for tag in TAGS])


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(values - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train_field(lines: list[tuple[list[str], list[str]]], decay: float = 2e-5) -> Field:
    """Maximises the likelihood of the tags by forward and backward sums over all lines at once."""
    known: dict = {}
    buckets = [token_buckets(tokens, known) for tokens, _ in lines]
    height, width = len(lines), max(len(b) for b in buckets)
    depth = max(len(x) for b in buckets for x in b)
    places = np.full((height, width, depth), BUCKETS)
    tags = np.zeros((height, width), int)
    mask = np.zeros((height, width), bool)
    for i, (found, (_, own)) in enumerate(zip(buckets, lines)):
        mask[i, : len(found)] = True
        tags[i, : len(found)] = [TAGS.index(tag) for tag in own]
        for j, one in enumerate(found):
            places[i, j, : len(one)] = one
    weights = [np.zeros((BUCKETS + 1, len(TAGS))), np.zeros((len(TAGS),) * 2), np.zeros(len(TAGS))]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    rows = np.arange(height)
    for count in range(1, STEPS + 1):
        grads = [decay * w for w in weights]
        emission = weights[0][places].sum(axis=2)
        step, start = weights[1] + allowed_steps(), weights[2] + allowed_start()
        forward = [start + emission[:, 0]]
        for t in range(1, width):
            new = _log_sum(forward[-1][:, :, None] + step, 1) + emission[:, t]
            forward.append(np.where(mask[:, t, None], new, forward[-1]))
        total = _log_sum(forward[-1], 1)
        back = np.zeros_like(forward[0])
        gap = np.zeros((height, width, len(TAGS)))
        for t in range(width - 1, -1, -1):
            gap[:, t] = np.exp(forward[t] + back - total[:, None]) * mask[:, t, None]
            gap[rows, t, tags[:, t]] -= mask[:, t]
            if t:
                ahead = emission[:, t] + back
                pair = np.exp(forward[t - 1][:, :, None] + step + ahead[:, None, :] - total[:, None, None])
                grads[1] += (pair * mask[:, t, None, None]).sum(axis=0) / height
                np.add.at(grads[1], (tags[:, t - 1][mask[:, t]], tags[:, t][mask[:, t]]), -1.0 / height)
                back = np.where(mask[:, t, None], _log_sum(step + ahead[:, None, :], 2), back)
        grads[2] += gap[:, 0].sum(axis=0) / height
        for k in range(depth):
            np.add.at(grads[0], places[:, :, k][mask], gap[mask] / height)
        for w, g, (m, v) in zip(weights, grads, moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= 0.15 * (m / (1 - 0.9**count)) / (np.sqrt(v / (1 - 0.99**count)) + 1e-6)
        weights[0][BUCKETS] = 0
    return Field(weights[0][:BUCKETS], weights[1] + allowed_steps(), weights[2] + allowed_start())


def decode(field: Field, lines: list[list[list[int]]]) -> list[np.ndarray]:
    """The best tags of each line by Viterbi, lines of similar length side by side."""
    tagged: list = [None] * len(lines)
    parts: list[list[int]] = []
    for i in sorted(range(len(lines)), key=lambda i: len(lines[i])):
        if not parts or (len(parts[-1]) + 1) * len(lines[i]) > CELLS:
            parts.append([])
        parts[-1].append(i)
    for part in parts:
        lengths = np.array([len(lines[i]) for i in part])
        width = int(lengths.max())
        emission = np.zeros((len(part), width, len(TAGS)))
        for row, i in enumerate(part):
            for t, places in enumerate(lines[i]):
                emission[row, t] = field.emission[places].sum(axis=0)
        best = field.start + emission[:, 0]
        came = np.zeros((len(part), width, len(TAGS)), np.int8)
        for t in range(1, width):
            through = best[:, :, None] + field.step
            came[:, t] = through.argmax(axis=1)
            new = through.max(axis=1) + emission[:, t]
            best = np.where((t < lengths)[:, None], new, best)
        last = best.argmax(axis=1)
        for row, i in enumerate(part):
            tags = np.empty(lengths[row], int)
            tag = int(last[row])
            for t in range(lengths[row] - 1, -1, -1):
                tags[t] = tag
                tag = int(came[row, t, tag]) if t else tag
            tagged[i] = tags
    return tagged


TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
#: Tokens of a line that are decoded around one that may be personal data. Words further off
#: are all alike, and a chain over words alone stays outside.
REACH = 8


def stretches(line: str) -> list[list[tuple[int, int]]]:
    """Runs of tokens around those with a hint, as places in the line."""
    tokens = [m.span() for m in TOKEN.finditer(line)]
    hints = [i for i, (a, b) in enumerate(tokens) if HINT.search(line, a, b)]
    found: list[list[int]] = []
    for i in hints:
        if found and i - REACH <= found[-1][1]:
            found[-1][1] = i + REACH
        else:
            found.append([max(0, i - REACH), i + REACH])
    return [tokens[a : b + 1] for a, b in found]


def plausible(kind: int, text: str) -> bool:
    digits = len(digits_of(text))
    if kind == 0:
        return "@" in text or bool(re.search(r"[\[({]at[\])}]", text, re.IGNORECASE))
    if kind == 1:
        return bool(re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", text)) and small_parts(text)
    if kind == 2:
        return 14 <= digits <= 19 and luhn(digits_of(text))
    return 9 <= digits <= 15 and not re.search(r"[A-Za-z]", text)


def field_spans(field: Field, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """(start, kind, stop) of what the field finds in each text."""
    lines, owners, known = [], [], {}
    for i, text in enumerate(texts):
        if not HINT.search(text):
            continue
        at = 0
        for line in text.split("\n"):
            if HINT.search(line):
                for run in stretches(line):
                    lines.append(token_buckets([line[a:b] for a, b in run], known))
                    owners.append((i, [(at + a, at + b) for a, b in run]))
            at += len(line) + 1
    found: list[list] = [[] for _ in texts]
    for tags, (i, places) in zip(decode(field, lines) if lines else [], owners):
        t = 0
        while t < len(tags):
            stop = t + 1
            if TAGS[tags[t]][0] == "B":
                while stop < len(tags) and tags[stop] == tags[t] + 1:
                    stop += 1
                kind, text = (tags[t] - 1) // 2, texts[i]
                a, b = places[t][0], places[stop - 1][1]
                b = a + len(text[a:b].rstrip("\"'“”‘’«»<>,;:!?."))
                a = b - len(text[a:b].lstrip("\"'“”‘’«»<>,;:!?."))
                if plausible(int(kind), text[a:b]):
                    found[i].append((a, int(kind), b))
            t = stop
    return found


# ---------------------------------------------------------------- the operator

SCHEMA = (
    "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
    "masked string"
)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span, or run of overlapping ones, replaced by the name of its kind."""
    out, at = [], 0
    for start, kind, stop in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, stop)
    return "".join([*out, text[at:]])


def find_personal_data(
    docs: DataFrame, key: str = "doc_id", text: str = "text", training: list | None = None
) -> DataFrame:
    """All columns of ``docs`` with counts of base matches, their digest, all spans and the
    masked text.

    The fixed patterns give the base spans. The field, trained on a small labelled table
    (``labelled_lines`` if none is given), decodes the lines that hold a digit, an @ or a
    bracketed "at", and adds spans that overlap no base span and hold as many digits as their
    kind needs. Whole texts are read; a row's result depends on its text alone.

    A null or empty text has no spans; its masked text stays null or empty. Keys may be null or
    repeat. Columns with the names of new ones give way to them. An empty table gives no rows.
    """
    new = [name.split()[0] for name in SCHEMA.split(", ")]
    kept = [c for c in docs.columns if c not in new]
    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept]
    field = train_field(training or labelled_lines())
    # plain values, as workers need no copy of the library to read them
    shared = docs.sparkSession.sparkContext.broadcast(vars(field))
    at = kept.index(text)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = Field(**shared.value)
        for part in slices(batches):
            values = part.column(at).to_pylist()
            texts = [value or "" for value in values]
            rows = []
            for value, whole, added in zip(values, texts, field_spans(learned, texts)):
                base = base_spans(whole)
                spans = sorted(base + [s for s in added if not any(b[0] < s[2] and s[0] < b[2] for b in base)])
                counts = [sum(kind == k for _, kind, _ in base) for k in range(len(KINDS))]
                digest = hashlib.sha256(listed(base).encode()).hexdigest()
                rows.append((*counts, digest, listed(spans), None if value is None else masked(whole, spans)))
            columns = list(zip(*rows))
            types = [pa.int64()] * 4 + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *[pa.array(c, t) for c, t in zip(columns, types)]], [*kept, *new]
            )

    return mapped(docs.select(*kept), find, ", ".join([*kinds, SCHEMA]))
