"""The template language, formatted conversations and what is read back from them."""

import hashlib
import random

import pytest

from orelode.llm import turns
from orelode.llm.chat_template import (
    MARKS,
    TemplateError,
    compile_template,
    escaped,
    format_conversations,
    read_back,
    unescaped,
)
from orelode.llm.turns import joined_ranges, placed_turns

SCHEMA = "conv_id long, turn long, role string, text string, index string, formatted int"
TALK = [{"role": "user", "text": "a"}, {"role": "assistant", "text": "b"}]


def rendered(source, messages=TALK, **constants):
    return compile_template(source, {**MARKS, **constants}).render(messages)


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        ("{% for m in messages %}{{ m.role|upper }}{% endfor %}END", "USERASSISTANTEND"),
        ("{{ 'x' ~ 1 + 2 }}{% for m in messages %}{% endfor %}", "x3"),
        ("{% set y = 'k' %}{% for m in messages %}{{ y }}{{ loop.index }}{% endfor %}", "k1k2"),
        ("{% for m in messages %}{% if loop.first %}F{% elif loop.last %}L{% else %}-{% endif %}{% endfor %}", "FL"),
        ("{% for m in messages %}{% if m.role == 'user' %}{% set y = 'q' %}{% endif %}{{ y }}.{% endfor %}", "q.."),
        ("{% for m in messages %}{{ 'u' if m.role in ['user'] and not false else m.text }}{% endfor %}", "ub"),
        ("{% for m in messages %}  {{- '}}' -}}  {# '%}' #} {%- endfor %} .", "}}}} ."),
        ("{% for m in messages %}{{ m.nothing | default('d') }}{{ m.nothing }}{% endfor %}", "dd"),
        ("{% for m in messages %}{{ loop.index0 % 2 }}{{ m.text | replace('a', 'z') | length }}{% endfor %}", "0111"),
        ("{% for m in messages %}{% for x in [1, m.text] %}{{ x }}{{ loop.last }}{% endfor %}{% endfor %}", "1falseatrue1falsebtrue"),
    ],
)
def test_templates_render(source, expected):
    assert rendered(source)[0] == expected


@pytest.mark.parametrize(
    "source",
    [
        "no loop",
        "{% for m in messages %}{% endfor %}{% for m in messages %}{% endfor %}",
        "{{ messages[0].role }}{% for m in messages %}{% endfor %}",
        "{% for m in messages %}{{ m.items() }}{% endfor %}",
        "{% for m in messages %}{{ os }}{% endfor %}",
        "{% for m in messages %}{{ m.text | shell }}{% endfor %}",
        "{% for m in messages %}{% include 'x' %}{% endfor %}",
        "{% for m in messages %}{{ 1 + }}{% endfor %}",
        "{% for m in messages %}{% if m.text %}{% endfor %}",
        "{% for m in messages %}{{ m.text * 99 }}{% endfor %}",
        "{% generation %}x{% endgeneration %}{% for m in messages %}{% endfor %}",
        "{% for m in messages %}{{ 'a' + 1 }}{% endfor %}",
    ],
)
def test_what_the_sandbox_lacks_does_not_compile(source):
    with pytest.raises(TemplateError):
        compile_template(source)


@pytest.mark.parametrize("expression", ["m.text.__class__", "m.text['x']", "'%s' % m.text", "m.text - 1", "m.role | length('x')"])
def test_values_have_no_way_out(expression):
    template = compile_template("{% for m in messages %}{{ " + expression + " }}{% endfor %}")
    with pytest.raises(TemplateError):
        template.render(TALK)
    missing = compile_template("{% for m in messages %}{{ m.__class__ }}{% endfor %}")
    assert missing.render(TALK)[0] == ""


def test_generation_marks_tell_the_spans():
    source = "<s>{% for m in messages %}{{ m.role }}:{% generation %}{{ m.text }}{% endgeneration %};{% endfor %}"
    text, spans = rendered(source)
    assert text == "<s>user:a;assistant:b;" and [text[a:b] for a, b in spans] == ["a", "b"]
    assert rendered(source, [])[0] == "<s>"


def test_constants_fold_to_fixed_text():
    nodes = compile_template("{% set a = 2 %}{% for m in messages %}{% if a + 1 == 3 %}{{ start }}y{% else %}{{ m.x.y }}{% endif %}{% endfor %}")
    assert nodes.piece({}, 0, False) == ("<|im_start|>y", [])


def test_escaping_is_reversible_and_hides_marks():
    dice = random.Random(2)
    for _ in range(3000):
        text = "".join(dice.choices(["<", "|", "\\", "im_end", "|>", "<|", "x"], k=dice.randint(0, 9)))
        assert unescaped(escaped(text)) == text
        assert "<|" not in escaped(text)


def talks(seed=4):
    dice = random.Random(seed)
    bits = ["<|im_end|>", "<|im_start|>", "<|im_sep|>", "\\", "<", "|", "\n", "é\U0001f600", " word"]
    rows = []
    for conv in range(40):
        for turn in range(dice.choice([1, 2, 3, 7, 60])):
            role = dice.choice(["user", "assistant", "assistant", "system", "a<|im_sep|>b\n", None])
            text = dice.choice([None, "", "".join(dice.choices(bits, k=dice.randint(1, 8)))])
            rows.append((conv, turn, role, text))
    rows += [rows[0], rows[0], (3, None, "user", "first"), (3, None, "assistant", "first"), (None, 1, "user", "x"), (None, None, None, None)]
    rows += [(99, 5, "assistant", "same")] * 50 + [(98, 0, "assistant", "long <| " * 20000)]
    dice.shuffle(rows)
    return [(*row, "clash", 1) for row in rows]


def expected_digests(rows):
    groups = {}
    for conv, turn, role, text, *_ in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    found = {}
    for conv, parts in groups.items():
        parts.sort()
        said = "".join(t for *_, r, t in parts if r == "assistant")
        formatted = "".join(f"<|im_start|>{escaped(r)}<|im_sep|>{escaped(t)}<|im_end|>\n" for *_, r, t in parts)
        found[conv] = (
            len(parts),
            hashlib.sha256("".join(f"{r}\n{t}\n" for *_, r, t in parts).encode()).hexdigest(),
            len(said),
            hashlib.sha256(said.encode()).hexdigest(),
            len(formatted),
        )
    return found


@pytest.mark.parametrize("partitions", [1, 7])
def test_digests_read_back_are_those_of_the_turns(spark, partitions):
    rows = talks()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions * 5))
    try:
        frame = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
        found = {r[0]: tuple(r)[1:] for r in read_back(format_conversations(frame)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == expected_digests(rows)


def test_pieces_join_to_the_rendered_conversation(spark):
    source = "<s>{% for m in messages %}{{ m.role }}={{ m.text }}{% if not loop.last %}, {% endif %}{% endfor %}</s>"
    rows = [(c, t, "user", f"{c}.{t}", "", 0) for c in range(6) for t in range(c + 1)]
    found = {}
    for r in sorted(format_conversations(spark.createDataFrame(rows, SCHEMA).repartition(5), source).collect()):
        found[r.conv_id] = found.get(r.conv_id, "") + r.formatted
    template = compile_template(source)
    for conv in range(6):
        messages = [{"role": "user", "text": f"{conv}.{t}"} for t in range(conv + 1)]
        assert found[conv] == template.render(messages)[0]


def test_no_conversations_give_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert placed_turns(empty).collect() == []
    assert read_back(format_conversations(empty)).collect() == []


def test_a_long_conversation_spreads_over_ranges(spark):
    rows = [(1, t, "user", str(t), "", 0) for t in range(3000)] + [(2, 0, "user", "x", "", 0)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        placed = placed_turns(spark.createDataFrame(rows, SCHEMA).repartition(4))
        found = sorted((r["conv_id"], r["index"], r["last"], r["text"]) for r in placed.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == [(1, t, t == 2999, str(t)) for t in range(3000)] + [(2, 0, True, "x")]


def test_ranges_join_over_several_of_them():
    def edge(part, first, final, head, tail, rows):
        return {"part": part, "first": first, "final": final, "head": head, "tail": tail, "rows": rows}

    edges = [edge(0, "a", "b", 2, 0, 3), edge(2, "b", "b", 4, 3, 4), edge(3, "b", "c", 1, 4, 6), edge(4, "d", "d", 1, 0, 1)]
    assert joined_ranges(edges) == [(0, 0, 2), (2, 1, 3), (3, 5, -1), (4, 0, -1)]
    assert turns.joined_ranges([]) == []
