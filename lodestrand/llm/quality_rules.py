"""Line-first cleaning of documents.

Every line of a text is judged by itself and fails if

* its punctuation is no prose: over 3 in 10 of its words end in signs such as
  ``***``, ``!!`` or ``&&&``, or none of its words has a letter or digit;
* it navigates: 3 or more free-standing separators (``|``, ``>``, ...) and at
  least one for each 5 words;
* it is boilerplate: it has a phrase of the list below and at most 40 words,
  or equals an earlier line of the text.

Failing lines go.  A document is rejected if it fails the base rules of
``judge`` or if over LOSS_PERCENT of its words are in lines that failed.

Defined results: null texts have no words (and fail the base rules); lines
without a word are neither judged nor kept; an empty table gives no rows;
repeated rows each give a row; columns other than doc_id and text are ignored
by ``judge`` and carried through by ``clean``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_WORDS, REPEAT_PERCENT, LOSS_PERCENT = 50, 50, 40
_BLANKS, _SYMBOLS = "\x20\x09\x0a\x0b\x0c\x0d", "#*$%&|<>"
# a word's last two signs; nothing is read again, however long the word
_SIGNED = re.compile(r"(?:!!|[#*$%&<>~^=_]{2})(?![^\x20\x09-\x0D])")
_SEPARATORS = re.compile(r"(?<![^\x20\x09-\x0D])(?:[|>»·•/\\:]|::|>>|->|=>)(?![^\x20\x09-\x0D])")
_LETTER = re.compile(r"[^\W_]")
# Phrases of lines that are no text of their own, in English, French, German and Spanish.
PHRASES = (
    "all rights reserved|cookie policy|we use cookies|privacy policy|terms of (?:use|service)|terms and conditions|enable javascript|"
    "lorem ipsum|subscribe to our|sign up for our|click here|powered by|skip to content|back to top|share this|follow us on|read more|"
    "tous droits réservés|nous utilisons des cookies|politique de confidentialité|mentions légales|conditions d'utilisation|abonnez-vous à|cliquez ici|retour en haut|lire la suite|"
    "alle rechte vorbehalten|wir verwenden cookies|datenschutzerklärung|allgemeine geschäftsbedingungen|nutzungsbedingungen|newsletter abonnieren|hier klicken|nach oben|weiterlesen|"
    "todos los derechos reservados|utilizamos cookies|política de privacidad|aviso legal|términos y condiciones|suscríbete a|haz clic aquí|volver arriba|leer más"
)
_BOILERPLATE = re.compile(PHRASES, re.I)


def line_fails(line: str) -> bool:
    """Whether a line with a word fails by itself (repeats are its document's matter)."""
    words = len(line.encode().split())
    if 10 * len(_SIGNED.findall(line)) > 3 * words or not _LETTER.search(line):
        return True
    separators = len(_SEPARATORS.findall(line))
    if separators >= 3 and 5 * separators >= words:
        return True
    return words <= 40 and _BOILERPLATE.search(line) is not None


def measure(text: str | None) -> tuple[int, int, int, int, int, bool, int, int, str]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words, base_failed, words lost with failing lines, failing lines, cleaned text."""
    text = text or ""
    words = text.encode("utf-8", "replace").split()
    n = len(words)
    chars = len(text) - sum(map(text.count, _BLANKS))
    seen: set[str] = set()
    kept, repeats, lost, failing = [], 0, 0, 0
    for line in text.split("\n"):
        if size := len(line.encode("utf-8", "replace").split()):
            again = line in seen
            seen.add(line)
            repeats += again
            if again or line_fails(line):
                lost, failing = lost + size, failing + 1
            else:
                kept.append(line)
    repeated = _repeat_words(words)
    base = n < MIN_WORDS or 100 * repeated > REPEAT_PERCENT * n
    return chars, sum(map(text.count, _SYMBOLS)), repeats, repeated, n, base, lost, failing, "\n".join(kept)


def _repeat_words(words: list[bytes]) -> int:
    """Words in 3-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, len(words))
    v = len(ids)
    if v < 2**21:
        windows = (w[:-2] * v + w[1:-1]) * v + w[2:]
    else:
        pairs = np.unique(w[:-2] * v + w[1:-1], return_inverse=True)[1]
        windows = pairs * v + w[2:]
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    again = times[which] > 1
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i : i + len(again)] |= again
    return int(covered.sum())


def judge(docs: DataFrame, loss_percent: int = LOSS_PERCENT) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, lost_words and failed_lines of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [measure(t)[:8] for t in b.column("text").to_pylist()]
            chars, symbols, dup, rep, n, base, lost, failing = zip(*rows) if rows else [()] * 8
            kept = [not f and 100 * x <= loss_percent * k for f, x, k in zip(base, lost, n)]
            longs = [pa.array(c, pa.int64()) for c in (n, chars, symbols, dup, rep)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *longs, pa.array(base, pa.bool_()), pa.array(kept, pa.bool_()), pa.array(lost, pa.int64()), pa.array(failing, pa.int64())], names=_NAMES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ", ".join(f"{c} {'boolean' if c in ('base_failed', 'kept') else 'long'}" for c in _NAMES))


_NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_words", "failed_lines"]


def clean(docs: DataFrame, loss_percent: int = LOSS_PERCENT) -> DataFrame:
    """The documents that are kept, without their failing lines (and with n_chars, if there is such a column, of what is left)."""
    has_chars = "n_chars" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(i, 512) for whole in batches for i in range(0, len(whole), 512)):
            rows = [measure(t) for t in b.column("text").to_pylist()]
            keep = pa.array([not r[5] and 100 * r[6] <= loss_percent * r[4] for r in rows], pa.bool_())
            b = b.set_column(b.schema.get_field_index("text"), "text", pa.array([r[8] if r[7] else t for r, t in zip(rows, b.column("text").to_pylist())], pa.string()))
            if has_chars:
                at = b.schema.get_field_index("n_chars")
                b = b.set_column(at, "n_chars", pa.array([len(t or "") for t in b.column("text").to_pylist()], pa.int64()))
            yield b.filter(keep)

    schema = T.StructType([T.StructField("n_chars", T.LongType()) if f.name == "n_chars" else f for f in docs.schema.fields])
    return docs.mapInArrow(run, schema)
