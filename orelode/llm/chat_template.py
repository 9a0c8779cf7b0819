"""Conversations formatted by a compiled template, with marks around what a model generates."""

from __future__ import annotations

import hashlib
import json
import operator
import re
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelode.llm.common import mapped
from orelode.llm.turns import placed_turns

#: The marks of a turn. Inside texts and roles, ``escape`` keeps them apart from marks.
MARKS = {"start": "<|im_start|>", "role_end": "<|im_sep|>", "end": "<|im_end|>"}

TEMPLATE = """\
{%- for message in messages -%}
    {{- start ~ (message.role | escape) ~ role_end -}}
    {%- if message.role == 'assistant' -%}
        {%- generation -%}{{ message.text | escape }}{%- endgeneration -%}
    {%- else -%}
        {{- message.text | escape -}}
    {%- endif -%}
    {{- end ~ '\\n' -}}
{%- endfor -%}
"""

PIECES = "conv_id long, index long, formatted string, starts array<int>, ends array<int>"
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def format_conversations(
    rows: DataFrame, template: str = TEMPLATE, constants: Mapping[str, object] = MARKS, **columns: str
) -> DataFrame:
    """``conv_id, index, formatted, starts, ends``: one piece of formatted text for each turn.

    The pieces of a conversation by ``index`` are its formatted text: the first one begins with what
    the template puts before its loop, the last one ends with what follows it. ``starts`` and
    ``ends`` are the code points of a piece between generation marks. Turns are ordered as in
    ``placed_turns``, which also says what nulls, repeated rows, other columns and empty tables
    give; texts may be empty or of any length. A conversation is formatted turn by turn by as many
    tasks as its rows lie in: no task needs all of it.
    """
    compile_template(template, constants)  # a wrong template fails here
    turns = placed_turns(rows, **columns)
    return mapped(turns, partial(format_rows, template=template, constants=dict(constants)), PIECES)


def format_rows(batches: Iterator[pa.RecordBatch], template: str, constants: dict) -> Iterator[pa.RecordBatch]:
    compiled = compile_template(template, constants)
    for batch in batches:
        conv, index, last, role, text = batch.columns
        pieces, starts, ends = [], [], []
        for i, final, r, t in zip(index.to_pylist(), last.to_pylist(), role.to_pylist(), text.to_pylist()):
            piece, spans = compiled.piece({"role": r, "text": t}, i, final)
            pieces.append(piece)
            starts.append([a for a, _ in spans])
            ends.append([b for _, b in spans])
        whole = pa.list_(pa.int32())
        yield pa.record_batch(
            [conv, index, pa.array(pieces, pa.string()), pa.array(starts, whole), pa.array(ends, whole)],
            [f.split()[0] for f in PIECES.split(", ")],
        )


def read_back(pieces: DataFrame, marks: Mapping[str, str] = MARKS) -> DataFrame:
    """Digests of each conversation's turns and generated texts, from its formatted pieces alone.

    SHA-256 reads a text from its beginning to its end, so the pieces of one conversation pass
    through one task, in order and one batch at a time; nothing of them is held.
    """
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "index")
    return mapped(ordered, partial(digest_rows, marks=dict(marks)), DIGESTS)


def digest_rows(batches: Iterator[pa.RecordBatch], marks: dict) -> Iterator[pa.RecordBatch]:
    start, role_end, end = (re.escape(marks[name]) for name in ("start", "role_end", "end"))
    turn = re.compile(f"{start}(.*?){role_end}(.*?){end}", re.DOTALL)
    names = [f.split()[0] for f in DIGESTS.split(", ")]
    now = None
    for batch in batches:
        done = []
        for conv, _, piece, starts, ends in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or now.conv != conv:
                if now is not None:
                    done.append(now.row())
                now = Digest(conv)
            now.chars += len(piece)
            for role, text in turn.findall(piece):
                now.turns += 1
                now.all.update(f"{unescaped(role)}\n{unescaped(text)}\n".encode())
            for a, b in zip(starts, ends):
                text = unescaped(piece[a:b])
                now.loss_chars += len(text)
                now.loss.update(text.encode())
        if done:
            yield digest_batch(done, names)
    if now is not None:
        yield digest_batch([now.row()], names)


def digest_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    conv, turns, all_hex, loss_chars, loss_hex, chars = zip(*rows)
    numbers = pa.int64()
    return pa.record_batch(
        [
            pa.array(conv, numbers), pa.array(turns, numbers), pa.array(all_hex), pa.array(loss_chars, numbers),
            pa.array(loss_hex), pa.array(chars, numbers),
        ],
        names,
    )


@dataclass
class Digest:
    """What has been read of a conversation."""

    conv: int | None
    turns: int = 0
    chars: int = 0
    loss_chars: int = 0
    all: object = field(default_factory=hashlib.sha256)
    loss: object = field(default_factory=hashlib.sha256)

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


# --- escaping ---------------------------------------------------------------------------


def escaped(text: str) -> str:
    r"""``<|`` becomes ``<\|``, and one more backslash joins those already there, so that no mark can
    begin inside a text and ``unescaped`` finds every text again."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


# --- the template language ----------------------------------------------------------------
#
# Text, {{ expression }}, {% if %} {% elif %} {% else %} {% endif %}, {% for x in list %}, {% set x = e %},
# {% generation %} and {# remarks #}; a minus at a bracket takes the white space beside it. A template
# reaches its constants, the turn, ``loop`` and what it sets: no attributes, no calls, no other names.


class TemplateError(ValueError):
    """A template that cannot be compiled, or an operation on values that have none."""


FILTERS: dict[str, Callable] = {
    "escape": lambda v: escaped(shown(v)),
    "trim": lambda v: shown(v).strip(),
    "upper": lambda v: shown(v).upper(),
    "lower": lambda v: shown(v).lower(),
    "length": len,
    "string": lambda v: shown(v),
    "tojson": lambda v: json.dumps(v, ensure_ascii=False),
    "default": lambda v, other: other if v is None else v,
    "replace": lambda v, old, new: shown(v).replace(shown(old), shown(new)),
}

BINARY: dict[str, Callable] = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt,
    ">=": operator.ge, "+": operator.add, "-": operator.sub, "%": lambda a, b: remainder(a, b),
    "~": lambda a, b: shown(a) + shown(b),
    "in": lambda a, b: a in b, "not in": lambda a, b: a not in b,
}

#: Operators by rank, the loosest first; ``and``, ``or`` and ``not`` stand above these.
RANKS = [("==", "!=", "<", "<=", ">", ">=", "in", "not in"), ("~",), ("+", "-"), ("%",)]


def shown(value) -> str:
    """A value as text: none is empty, truth values as the language writes them."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    return value if isinstance(value, str) else str(value)


def remainder(a, b):
    if isinstance(a, str):
        raise TemplateError("% takes numbers")  # a text would be a format string
    return a % b


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    of: object
    key: object


@dataclass(frozen=True)
class Call:
    """A built-in function of other expressions: an operator or a filter."""

    function: Callable
    parts: tuple


@dataclass(frozen=True)
class Choice:
    """``then if test else other``; ``a and b``, ``a or b`` give one of their sides."""

    test: object
    then: object
    other: object


@dataclass(frozen=True)
class Output:
    value: object


@dataclass(frozen=True)
class If:
    test: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class Set:
    name: str
    value: object


@dataclass(frozen=True)
class Generation:
    body: tuple


QUOTED = r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\""
BRACKET = re.compile(
    rf"(?s)\{{\{{(-?)((?:{QUOTED}|(?!-?\}}\}}).)*)(-?)\}}\}}"
    rf"|\{{%(-?)((?:{QUOTED}|(?!-?%\}}).)*)(-?)%\}}"
    rf"|\{{#(-?)(?:(?!-?#\}}).)*(-?)#\}}"
)
TOKEN = re.compile(rf"\s*(?:({QUOTED})|(\d+)|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+~%<>|.,()\[\]=]))")


def pieces_of(source: str) -> Iterator[tuple[str, str]]:
    """``("text" | "output" | "statement", content)`` in order."""
    place, strip = 0, ""
    for found in BRACKET.finditer(source):
        o1, output, o2, s1, statement, s2, r1, r2 = found.groups()
        text = source[place : found.start()]
        text = text.lstrip() if strip else text
        yield "text", text.rstrip() if o1 or s1 or r1 else text
        if output is not None:
            yield "output", output
        elif statement is not None:
            yield "statement", statement
        strip = o2 or s2 or r2
        place = found.end()
    yield "text", source[place:].lstrip() if strip else source[place:]


class Parser:
    """The syntax tree of a template."""

    def __init__(self, source: str):
        self.pieces = list(pieces_of(source))
        self.place = 0

    def block(self, *ends: str) -> tuple[tuple, str, list]:
        """Nodes up to a statement that begins with one of ``ends``: the nodes, it, its other tokens."""
        nodes = []
        while self.place < len(self.pieces):
            kind, content = self.pieces[self.place]
            self.place += 1
            if kind == "text":
                nodes.append(Output(Const(content)))
                continue
            tokens = Tokens(content)
            if kind == "output":
                nodes.append(Output(tokens.whole()))
                continue
            word = tokens.name()
            if word in ends:
                return tuple(nodes), word, tokens
            nodes.append(self.statement(word, tokens))
        if ends:
            raise TemplateError(f"missing {' or '.join(ends)}")
        return tuple(nodes), "", None

    def statement(self, word: str, tokens: Tokens):
        if word == "if":
            return self.condition(tokens)
        if word == "set":
            name = tokens.name()
            tokens.expect("=")
            return Set(name, tokens.whole())
        if word == "for":
            name = tokens.name()
            tokens.expect("in")
            over = tokens.whole()
            body, _, _ = self.block("endfor")
            return For(name, over, body)
        if word == "generation":
            body, _, _ = self.block("endgeneration")
            return Generation(body)
        raise TemplateError(f"unknown statement {word}")

    def condition(self, tokens: Tokens) -> If:
        test = tokens.whole()
        then, word, rest = self.block("elif", "else", "endif")
        if word == "elif":
            return If(test, then, (self.condition(rest),))
        other = self.block("endif")[0] if word == "else" else ()
        return If(test, then, other)


class Tokens:
    """The expression inside one bracket."""

    def __init__(self, content: str):
        self.all, place = [], 0
        while content[place:].strip():
            found = TOKEN.match(content, place)
            if not found:
                raise TemplateError(f"cannot read {content[place:].strip()!r}")
            self.all.append(found.groups())
            place = found.end()
        self.at = 0

    def peek(self) -> str | None:
        if self.at == len(self.all):
            return None
        quoted, number, name, sign = self.all[self.at]
        return name or sign or None

    def take(self, *words: str) -> str | None:
        """The next word if it is one of these; ``not in`` counts as one."""
        word = self.peek()
        if word == "not" and "not in" in words and self.at + 1 < len(self.all) and self.all[self.at + 1][2] == "in":
            self.at += 2
            return "not in"
        if word in words:
            self.at += 1
            return word
        return None

    def expect(self, word: str) -> None:
        if not self.take(word):
            raise TemplateError(f"expected {word}")

    def name(self) -> str:
        if self.at == len(self.all) or not self.all[self.at][2]:
            raise TemplateError("expected a name")
        self.at += 1
        return self.all[self.at - 1][2]

    def whole(self):
        value = self.choice()
        if self.at != len(self.all):
            raise TemplateError(f"unexpected {self.all[self.at]}")
        return value

    def choice(self):
        value = self.either()
        if self.take("if"):
            test = self.either()
            other = self.choice() if self.take("else") else Const(None)
            return Choice(test, value, other)
        return value

    def either(self):
        value = self.both()
        while self.take("or"):
            value = Choice(value, value, self.both())
        return value

    def both(self):
        value = self.negated()
        while self.take("and"):
            value = Choice(value, self.negated(), value)
        return value

    def negated(self):
        if self.take("not"):
            return Call(operator.not_, (self.negated(),))
        return self.ranked(0)

    def ranked(self, rank: int):
        if rank == len(RANKS):
            return self.filtered()
        value = self.ranked(rank + 1)
        while sign := self.take(*RANKS[rank]):
            value = Call(BINARY[sign], (value, self.ranked(rank + 1)))
        return value

    def filtered(self):
        value = self.item()
        while self.take("|"):
            name = self.name()
            if name not in FILTERS:
                raise TemplateError(f"unknown filter {name}")
            parts = [value]
            if self.take("("):
                while not self.take(")"):
                    parts.append(self.choice())
                    self.take(",")
            value = Call(FILTERS[name], tuple(parts))
        return value

    def item(self):
        value = self.atom()
        while True:
            if self.take("."):
                value = Item(value, Const(self.name()))
            elif self.take("["):
                value = Item(value, self.choice())
                self.expect("]")
            else:
                return value

    def atom(self):
        if self.at == len(self.all):
            raise TemplateError("expression ends early")
        quoted, number, name, sign = self.all[self.at]
        self.at += 1
        if quoted:
            return Const(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), quoted[1:-1], flags=re.S))
        if number:
            return Const(int(number))
        if name:
            fixed = {"true": True, "false": False, "none": None}
            return Const(fixed[name]) if name in fixed else Name(name)
        if sign == "(":
            value = self.choice()
            self.expect(")")
            return value
        if sign == "[":
            parts = []
            while not self.take("]"):
                parts.append(self.choice())
                self.take(",")
            return Call(lambda *values: list(values), tuple(parts))
        raise TemplateError(f"unexpected {sign}")


# --- folding ------------------------------------------------------------------------------


def folded(node, known: Mapping[str, object], bound: frozenset[str]):
    """The expression with all that is known put in; ``bound`` are the names of the turn."""
    if isinstance(node, Name):
        if node.name in bound:
            return node
        if node.name in known:
            return Const(known[node.name])
        raise TemplateError(f"unknown name {node.name}")
    if isinstance(node, Item):
        of, key = folded(node.of, known, bound), folded(node.key, known, bound)
        return Const(item_of(of.value, key.value)) if constant(of, key) else Item(of, key)
    if isinstance(node, Call):
        parts = tuple(folded(part, known, bound) for part in node.parts)
        return Const(called(node.function, [p.value for p in parts])) if constant(*parts) else Call(node.function, parts)
    if isinstance(node, Choice):
        test = folded(node.test, known, bound)
        if isinstance(test, Const):
            return folded(node.then if test.value else node.other, known, bound)
        return Choice(test, folded(node.then, known, bound), folded(node.other, known, bound))
    return node


def constant(*nodes) -> bool:
    return all(isinstance(node, Const) for node in nodes)


def folded_block(nodes: tuple, known: Mapping[str, object], bound: frozenset[str]) -> tuple[tuple, dict, frozenset[str]]:
    """Nodes with constants put in, decided branches taken and texts in a row joined; then what is
    known, and which names have a value, behind them."""
    known, out = dict(known), []
    for node in nodes:
        if isinstance(node, Output):
            parts = [Output(folded(node.value, known, bound))]
        elif isinstance(node, If):
            test = folded(node.test, known, bound)
            if isinstance(test, Const):
                parts, known, bound = folded_block(node.then if test.value else node.other, known, bound)
            else:
                then, _, bound_then = folded_block(node.then, known, bound)
                other, _, bound_other = folded_block(node.other, known, bound)
                parts = [If(test, then, other)]
                bound = bound | bound_then | bound_other | assigned(then) | assigned(other)
        elif isinstance(node, Set):
            value = folded(node.value, known, bound)
            parts = [Set(node.name, value)]
            if isinstance(value, Const):
                known[node.name] = value.value
                bound = bound - {node.name}
            else:
                bound = bound | {node.name}
        elif isinstance(node, For):
            over = folded(node.over, known, bound)
            inner = bound | {node.name, "loop"} | assigned(node.body)
            parts = [For(node.name, over, folded_block(node.body, known, inner)[0])]
        else:
            body, known, bound = folded_block(node.body, known, bound)
            parts = [Generation(body)]
        for part in parts:
            if isinstance(part, Output) and isinstance(part.value, Const):
                text = shown(part.value.value)
                if out and isinstance(out[-1], Output) and isinstance(out[-1].value, Const):
                    text = out.pop().value.value + text
                if text:
                    out.append(Output(Const(text)))
            else:
                out.append(part)
    return tuple(out), known, bound


def assigned(nodes: tuple) -> frozenset[str]:
    """Names that some node sets, in whatever branch."""
    names = frozenset()
    for node in nodes:
        if isinstance(node, Set):
            names |= {node.name}
        elif isinstance(node, If):
            names |= assigned(node.then) | assigned(node.other)
        elif isinstance(node, (For, Generation)):
            names |= assigned(node.body)
    return names


# --- closures -------------------------------------------------------------------------------


class Writer:
    """The text so far, and the spans between generation marks."""

    def __init__(self):
        self.parts, self.length, self.spans = [], 0, []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def item_of(value, key):
    """A part of a mapping or list; what is not there is none."""
    if isinstance(value, Mapping):
        return value.get(key)
    if isinstance(value, (list, tuple, str)) and isinstance(key, int):
        return value[key] if -len(value) <= key < len(value) else None
    raise TemplateError(f"{type(value).__name__} has no parts")


def called(function: Callable, values: list):
    try:
        return function(*values)
    except TypeError as error:
        raise TemplateError(str(error)) from None


def evaluator(node) -> Callable[[dict], object]:
    """A closure that gives the value of an expression among the names of a turn."""
    if isinstance(node, Const):
        value = node.value
        return lambda names: value
    if isinstance(node, Name):
        name = node.name
        return lambda names: names.get(name)
    if isinstance(node, Item):
        of, key = evaluator(node.of), evaluator(node.key)
        return lambda names: item_of(of(names), key(names))
    if isinstance(node, Choice):
        test, then, other = evaluator(node.test), evaluator(node.then), evaluator(node.other)
        return lambda names: then(names) if test(names) else other(names)
    function, parts = node.function, [evaluator(part) for part in node.parts]
    return lambda names: called(function, [part(names) for part in parts])


def renderer(nodes: tuple) -> Callable[[dict, Writer], None]:
    """A closure that writes the nodes."""
    steps = [step(node) for node in nodes]

    def run(names: dict, out: Writer) -> None:
        for one in steps:
            one(names, out)

    return steps[0] if len(steps) == 1 else run


def step(node) -> Callable[[dict, Writer], None]:
    if isinstance(node, Output):
        if isinstance(node.value, Const):
            text = node.value.value
            return lambda names, out: out.write(text)
        value = evaluator(node.value)
        return lambda names, out: out.write(shown(value(names)))
    if isinstance(node, If):
        test, then, other = evaluator(node.test), renderer(node.then), renderer(node.other)
        return lambda names, out: (then if test(names) else other)(names, out)
    if isinstance(node, Set):
        name, value = node.name, evaluator(node.value)

        def assign(names: dict, out: Writer) -> None:
            names[name] = value(names)

        return assign
    body = renderer(node.body)
    if isinstance(node, Generation):

        def generate(names: dict, out: Writer) -> None:
            begun = out.length
            body(names, out)
            out.spans.append((begun, out.length))

        return generate
    name, over = node.name, evaluator(node.over)

    def repeat(names: dict, out: Writer) -> None:
        values = over(names)
        if not isinstance(values, (list, tuple)):
            raise TemplateError("for takes a list")
        for index, value in enumerate(values):
            body({**names, name: value, "loop": loop_names(index, index == len(values) - 1)}, out)

    return repeat


def loop_names(index: int, last: bool) -> dict:
    return {"index0": index, "index": index + 1, "first": index == 0, "last": last}


@dataclass(frozen=True)
class Template:
    """A compiled template: constant texts around a loop over the turns of a conversation."""

    before: str
    name: str
    turn: Callable[[dict, Writer], None]
    after: str

    def piece(self, message: Mapping, index: int, last: bool) -> tuple[str, list[tuple[int, int]]]:
        """The text that one turn adds to its conversation, and the generated spans in it."""
        out = Writer()
        if index == 0:
            out.write(self.before)
        self.turn({self.name: message, "loop": loop_names(index, last)}, out)
        if last:
            out.write(self.after)
        return "".join(out.parts), out.spans

    def render(self, messages: list[Mapping]) -> tuple[str, list[tuple[int, int]]]:
        """A whole conversation that lies in memory; without turns, what stands around the loop."""
        if not messages:
            return self.before + self.after, []
        texts, spans, length = [], [], 0
        for index, message in enumerate(messages):
            text, found = self.piece(message, index, index == len(messages) - 1)
            texts.append(text)
            spans += [(a + length, b + length) for a, b in found]
            length += len(text)
        return "".join(texts), spans


def compile_template(source: str, constants: Mapping[str, object] = MARKS) -> Template:
    """Closures for a template with one loop over ``messages`` at its top.

    Outside that loop a template knows its constants alone, so what stands there folds to fixed
    text; inside, a turn knows itself and its ``loop``. A turn can therefore be written without
    the others. What a turn sets is gone in the next one.
    """
    nodes, _, _ = Parser(source).block()
    loops = [i for i, node in enumerate(nodes) if isinstance(node, For) and node.over == Name("messages")]
    if len(loops) != 1:
        raise TemplateError("a template has one loop over messages at its top")
    loop = nodes[loops[0]]
    first, known, bound = folded_block(nodes[: loops[0]], constants, frozenset())
    names = frozenset({loop.name, "loop"})
    if bound:
        raise TemplateError("only constants are known outside the loop")
    body, _, _ = folded_block(loop.body, {k: v for k, v in known.items() if k not in names}, names)
    after, _, _ = folded_block(nodes[loops[0] + 1 :], known, frozenset())
    return Template(fixed_text(first), loop.name, renderer(body), fixed_text(after))


def fixed_text(nodes: tuple) -> str:
    """The text of nodes that know constants alone; loops over lists are run here."""
    out = Writer()
    renderer(nodes)({}, out)
    if out.spans:
        raise TemplateError("generation marks belong into the loop over messages")
    return "".join(out.parts)
