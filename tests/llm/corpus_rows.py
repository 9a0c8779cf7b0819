"""Rows for the tests of this folder."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, component string, size string"


def make_docs(seed=3, count=120):
    """Texts with exact and near copies, shared passages, odd white space, nulls and repeats."""
    dice = random.Random(seed)
    vocabulary = ["".join(dice.choices("abcdefgh", k=dice.randint(1, 6))) for _ in range(400)]
    passage = " ".join(dice.choices(vocabulary, k=60))
    texts = []
    for i in range(count):
        words = dice.choices(vocabulary, k=dice.choice([0, 1, 2, 3, 13, 40, 90, 150]))
        kind = i % 8
        if kind == 1 and texts:
            texts.append(dice.choice(texts))
            continue
        if kind == 2 and texts:
            words = (dice.choice(texts) or "").split()
            for _ in range(dice.randint(1, 4)):
                if words:
                    words[dice.randrange(len(words))] = dice.choice(vocabulary)
        if kind == 3:
            words[len(words) // 2 : len(words) // 2] = passage.split()
        if kind == 4:
            words = [w.upper() for w in words]
        texts.append(dice.choice([" ", "\n", "  ", "\t"]).join(words))
    texts += [None, "", "   ", "é ü x \U0001f600 y", "word " * 3000, "one two", "One TWO"]
    rows = [
        (i, t, dice.choice(["en", "de", None]), f"s{i % 3}" if i % 7 else None, 0, "x", "y")
        for i, t in enumerate(texts)
    ]
    return rows + [rows[5], rows[5], (None, texts[7], "en", "s1", 0, "x", "y"), (None, None, None, None, 0, "x", "y")]


def keyed(frame, key="doc_id"):
    """Rows by key; rows with one key have to be equal in these fixtures."""
    found = {}
    for row in frame.collect():
        values = row.asDict(recursive=True)
        assert found.setdefault(row[key], values) == values
    return found
