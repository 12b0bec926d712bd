"""License scans: exact phrases, and short notices found with a bounded number of edits.

A text is lower-cased (A-Z) and cut into words; words joined by single spaces are searched. For a notice and k
edits, k + 1 pieces of it are sought exactly (one of them stands unchanged in any text within k edits); around
each find the ``regex`` library's bounded-error matching verifies the notice and gives its span and edits.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemark.llm.common import documents, map_batches

# Phrases that stand word by word, with their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Notices sought with edits, with their labels and the most edits.
NOTICES = {
    "released under the mit license": ("mit", 2),
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 5),
    "licensed under the apache license version 2 0": ("apache-2", 3),
    "licensed under cc by nc 4 0": ("cc-by-nc", 1),
    "licensed under cc by sa 4 0": ("cc-by-sa", 1),
    "licensed under the gnu general public license version 3": ("gpl-3", 3),
    "gnu lesser general public license": ("lgpl", 2),
    "redistribution and use in source and binary forms": ("bsd", 3),
    "subject to the terms of the mozilla public license": ("mpl", 3),
}
_WORDS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in bytes(range(256)).lower())
SPANS = "array<struct<label:string, first_word:long, last_word:long, edits:int, notice_length:int, exact:boolean>>"


def pieces(notice: bytes, edits: int) -> list[tuple[int, bytes]]:
    """edits + 1 parts of the notice with their offsets."""
    cuts = [round(i * len(notice) / (edits + 1)) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


@cache
def _compiled(notices: tuple) -> list:
    return [(n.encode(), label, k, pieces(n.encode(), k), regex.compile(rb"(?e)(?: |^)(%s){e<=%d}(?= |$)" % (regex.escape(n).encode(), k))) for n, (label, k) in notices]


def _places(hay: bytes, needle: bytes) -> list[int]:
    out, at = [], hay.find(needle)
    while at >= 0:
        out.append(at)
        at = hay.find(needle, at + 1)
    return out


def scan_text(text: str | None, phrases: dict = PHRASES, notices: dict = NOTICES) -> tuple[int, list[dict]]:
    """Number of words, and spans in words: exact phrases first, then notices."""
    words = (text or "").encode("utf-8", "replace").lower().translate(_WORDS).split()
    hay = b" %s " % b" ".join(words) if words else b""
    spaces = np.flatnonzero(np.frombuffer(hay, np.uint8) == 32)
    word_at = lambda at: int(np.searchsorted(spaces, at, "right")) - 1  # noqa: E731  the word that begins after the last space up to here
    spans = []
    for phrase, label in phrases.items():
        for at in _places(hay, b" %s " % phrase.encode()):
            first = word_at(at)
            spans.append({"label": label, "first_word": first, "last_word": first + phrase.count(" "), "edits": 0, "notice_length": len(phrase), "exact": True})
    for notice, label, k, parts, pattern in _compiled(tuple(notices.items())):
        reach = [(at - off - k - 1, at - off + len(notice) + k + 2) for off, part in parts for at in _places(hay, part)]
        windows: list[list[int]] = []
        for a, b in sorted(reach):
            if windows and a <= windows[-1][1]:
                windows[-1][1] = max(b, windows[-1][1])
            else:
                windows.append([max(0, a), b])
        for a, b in windows:
            for m in pattern.finditer(hay, a, min(b, len(hay))):
                body = hay[m.start(1) : m.end(1)]
                if not body.strip():
                    continue
                first = word_at(m.start(1) + len(body) - len(body.lstrip()))
                spans.append({"label": label, "first_word": first, "last_word": first + body.strip().count(b" "), "edits": sum(m.fuzzy_counts), "notice_length": len(notice), "exact": False})
    return len(words), spans


def scan(docs: DataFrame, phrases: dict | None = None, notices: dict | None = None) -> DataFrame:
    """(doc_id, n_words, spans, score) of every row, whole texts. score: the best of 1 - edits / length over the spans, 0 without any.

    Null and empty texts have no words and no spans; null ids stay null and repeated rows are scanned each. An empty
    table gives no rows. Only id and text are read: other columns may have any names.
    """
    own, fuzzy = phrases or PHRASES, notices or NOTICES

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [scan_text(t, own, fuzzy) for t in batch["text"].to_pylist()]
        kind = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32()), ("notice_length", pa.int32()), ("exact", pa.bool_())]))
        score = [max((1 - s["edits"] / s["notice_length"] for s in spans), default=0.0) for _, spans in found]
        return pa.record_batch([batch["doc_id"], pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], kind), pa.array(score, pa.float64())], ["doc_id", "n_words", "spans", "score"])

    return map_batches(documents(docs), run, f"doc_id long, n_words long, spans {SPANS}, score double")
