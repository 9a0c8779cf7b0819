"""Line-first cleaning: rules judge single lines, then the document by what they leave."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from orelode.llm.common import SPACES, Cache, covered, mapped, slices, window_hashes

# What counts as a symbol, and the width of a repeated window.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8

ENDS = re.compile(r"[.!?:;…。！？؟।۔](?:[\"'»”’)\]]|\s|$)")
SEPARATORS = re.compile(r"\s[|•»·>/]\s")
#: Notices: they fail a line that begins with one, or of whose words they are a good part.
NOTICE = re.compile(
    r"(?:©|\(c\)|\bcopyright\b)\s*(?:©|\(c\))?\s*(?:19|20)\d\d\b|\ball rights reserved\b|"
    r"\b(?:this work is )?licensed under\b|\breleased under (?:the|an?) .*\blicen[cs]e\b|"
    r"\bterms (?:of (?:use|service)|(?:and|&) conditions)\b|\bprivacy policy\b|\blorem ipsum dolor\b|"
    r"\balle rechte vorbehalten\b|\bdatenschutzerklärung\b|\bnutzungsbedingungen\b|"
    r"\btous droits réservés\b|\bpolitique de confidentialité\b|\bconditions d['’]utilisation\b|"
    r"\b(?:todos los derechos reservados|todos os direitos reservados|tutti i diritti riservati)\b|"
    r"\bpolítica de privacid(?:ad|ade)\b|\binformativa sulla privacy\b|\balle rechten voorbehouden\b",
    re.IGNORECASE,
)
#: A notice that does not begin its line has to hold one in so many of its words.
NOTICE_SHARE = 3
#: Requests to the reader: they fail a line that begins with one, if it ends there or goes on as
#: a request does. "Sign in the window" and "read more books" are none.
PROMPT = re.compile(
    r"\W*(?:please )?(?:"
    r"(?:(?:click|tap) here|read more|learn more|find out more|sign (?:in|up)|log ?in|log on|register|subscribe|"
    r"share (?:this|on)|follow us)"
    r"(?=\W*$|[.,!:;»→>|]|\s+(?:to|or|with|via|about|on|at|for|here|now|today|below|our|your)\b)|"
    r"(?:we|this (?:web)?site|our (?:web)?site) uses? cookies\b|accept (?:all )?cookies\b|"
    r"by (?:continuing to (?:use|browse)|using) (?:this|our) (?:web)?site\b|"
    r"(?:you need to )?enable javascript\b|javascript (?:is|must be|seems to be) (?:disabled|required|enabled)\b|"
    r"(?:weiterlesen|mehr (?:lesen|erfahren)|hier klicken|jetzt (?:anmelden|abonnieren)|"
    r"lire la suite|en savoir plus|cliquez ici|leer más|haga clic aquí|inici(?:a|ar) sesión|"
    r"leia mais|clique aqui|leggi (?:tutto|di più)|clicca qui|lees meer|klik hier)"
    r"(?=\W*$|[.,!:;»→>|]))",
    re.IGNORECASE,
)
#: A line that is longer than this is prose, whatever it begins with.
BOILERPLATE_WORDS = 25
#: Symbols a word that a line may hold, and words a menu entry may have.
SYMBOLS_PER_WORD = 0.5
ENTRY_WORDS = 3
#: Share of its words that a document may lose with its failed lines.
MOST_LOST = 0.5

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, n_failed_lines long, "
    "n_kept_words long, cleaned string"
)


def is_notice(line: str, n_words: int) -> bool:
    """Whether a line begins with a notice, or notices hold enough of its words."""
    found = list(NOTICE.finditer(line))
    if not found:
        return False
    if not any(map(str.isalnum, line[: found[0].start()])):
        return True
    return NOTICE_SHARE * sum(len(one[0].split()) for one in found) >= n_words


def line_fault(line: str, n_words: int) -> str | None:
    """The first rule that a line with words fails; None for a good line."""
    symbols = sum(line.count(c) for c in SYMBOLS.decode())
    parts = len(SEPARATORS.findall(line)) + 1
    if parts >= 4 and n_words - (parts - 1) <= ENTRY_WORDS * parts:
        return "navigation"
    if symbols > SYMBOLS_PER_WORD * n_words and symbols > 3:
        return "symbols"
    if n_words <= BOILERPLATE_WORDS and (PROMPT.match(line) or is_notice(line, n_words)):
        return "boilerplate"
    if not ENDS.search(line):
        return "punctuation"
    return None


def clean_text(text: str | None, hashes: Cache) -> tuple:
    """The figures of one document, in the order of ``SCHEMA``."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    total = len(words)
    word_chars = len(text) - (len(raw) - len(raw.translate(None, SPACES)))
    n_symbols = len(raw) - len(raw.translate(None, SYMBOLS))

    lines = text.split("\n")
    counts = [len(line.encode("utf-8", "surrogatepass").split()) for line in lines]
    worded = [line for line, count in zip(lines, counts) if count]
    n_dup_lines = len(worded) - len(set(worded))

    n_repeat = 0
    if total > WINDOW:
        found = window_hashes(np.fromiter(map(hashes.__getitem__, words), np.uint64, total), WINDOW)
        order = np.argsort(found, kind="stable")
        same = found[order][1:] == found[order][:-1]
        repeated = np.zeros(len(found), bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        n_repeat = int(covered(np.flatnonzero(repeated), WINDOW, total).sum())

    base_failed = total < 20 or 100 * n_repeat > 30 * total
    faults = [line_fault(line, count) if count else None for line, count in zip(lines, counts)]
    kept_words = sum(count for count, fault in zip(counts, faults) if fault is None)
    kept = not base_failed and kept_words >= (1 - MOST_LOST) * total
    cleaned = "\n".join(line for line, fault in zip(lines, faults) if fault is None)
    return (
        total,
        word_chars,
        n_symbols,
        n_dup_lines,
        n_repeat,
        base_failed,
        kept,
        len(worded),
        sum(fault is not None for fault in faults),
        kept_words,
        cleaned,
    )


def clean_lines(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Every document with its figures, its verdict and its text without the failed lines.

    A line fails as navigation (four or more short entries between separators), for symbols
    (more than one to two words), as boilerplate (a short line that begins with a notice or a
    request to the reader, or a third of whose words are notices) or for
    punctuation (no sentence ends in it). A document is kept unless it has under 20 words,
    over 30% of its words lie in 8-word windows that it repeats, or its failed lines hold more
    than half of its words.

    A null or empty text has no words and is not kept. Keys may be null or repeated: each row
    is judged on its own, and no other column is read. An empty table gives no rows.
    """
    names = [field.split()[0] for field in SCHEMA.split(", ")]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Cache(xxhash.xxh3_64_intdigest)
        for part in slices(batches):
            found = [clean_text(value, hashes) for value in part.column(1).to_pylist()]
            columns = [pa.array([row[i] for row in found], kind) for i, kind in enumerate(KINDS)]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], [key, *names])

    kind = docs.schema[key].dataType.simpleString()
    return mapped(docs.select(key, text), judge, f"{key} {kind}, {SCHEMA}")


KINDS = [
    {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}[field.split()[1]]
    for field in SCHEMA.split(", ")
]
