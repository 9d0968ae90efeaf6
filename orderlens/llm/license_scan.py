"""Licence notices: exact phrases, and fuzzy search for short notices.

A text is reduced to its words (A-Z lower-cased, everything else in ASCII but
letters and digits separates), joined by one blank.  Exact phrases are found as
runs of whole words.  Fuzzy search splits a notice into one part more than the
edits it may have; whatever matches with so few edits holds at least one part
unchanged (pigeonhole), so exact searches for the parts find every candidate.
The ``regex`` library's bounded-error matching then verifies the edits around a
candidate and reports the span, which begins and ends at word borders.  The words
that tell one licence from another must be words of the text too, equal or (from
three letters on) with one edit.

Defined cases: null text counts as empty; a text without words has no places, no
labels and score 0; overlapping places all count; every row gives one row.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Exact phrases with their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Notices searched with errors: text, label, edits allowed.  Words in brackets name the licence.
NOTICES = (
    ("released under the [mit] license", "mit", 3),
    ("permission [is hereby granted] free of charge to any person obtaining a copy", "mit", 6),
    ("licensed under the [apache] license [version 2]", "apache-2", 4),
    ("licensed under [cc by nc] 4", "cc-by-nc", 2),
    ("creative commons attribution [noncommercial]", "cc-by-nc", 4),
    ("[gnu general] public license", "gpl", 3),
    ("[gnu lesser general] public license", "lgpl", 3),
    ("[mozilla] public license", "mpl", 2),
    ("[redistribution] and use in [source] and [binary] forms", "bsd", 4),
)
#: Bytes of candidates that are verified at once, in lengths of the notice.
STRETCH = 8
#: Shorter naming words (2, nc, by) must be equal: one edit makes another licence of them.
LEAST_NAME = 3

_UPPER = bytes(range(65, 91))
_SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_TABLE = bytes(
    b + 32 if b in _UPPER else 32 if b in _SEPARATORS else b for b in range(256))


def normalise(text: str) -> bytes:
    """Words joined by one blank, with a blank at both ends."""
    return b" " + b" ".join(text.encode("utf-8", "replace").translate(_TABLE).split()) + b" "


def parts(notice: str, edits: int) -> list[tuple[int, bytes]]:
    """(offset, text) of ``edits + 1`` parts of about equal length."""
    ends = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b].encode()) for a, b in zip(ends, ends[1:])]


def bounded(notice: str, edits: int) -> str:
    """Pattern of whole words: at most ``edits`` errors in all, at most one of them in each
    naming word, and none between naming words that stand together."""
    import regex

    def naming(run: str) -> str:
        # {s<=0} allows no error; {e<=0} would be dropped, and the outer bound would hold
        each = (f"(?:{regex.escape(w)}){{{'e<=1' if len(w) >= LEAST_NAME else 's<=0'}}}" for w in run.split(" "))
        return f"(?<= ){'(?: ){s<=0}'.join(each)}(?= )"

    pieces = [naming(x[1:-1]) if x.startswith("[") else regex.escape(x)
              for x in regex.split(r"(\[[^]]*\])", notice) if x]
    return f"(?b)(?<= )(?:{''.join(pieces)}){{e<={edits}}}(?= )"


class Scanner:
    def __init__(self, base=BASE, notices=NOTICES):
        import regex

        self.base = [(f" {p} ".encode(), label) for p, label in base]
        self.notices = []
        for marked, label, k in notices:
            n = marked.replace("[", "").replace("]", "")
            self.notices.append((n, label, k, parts(n, k), regex.compile(bounded(marked, k))))

    def exact(self, words: bytes, blanks: list[int]) -> list[tuple[int, str]]:
        """(first word, label) of every place of a base phrase; ``blanks``: places of the blanks."""
        found = []
        for phrase, label in self.base:
            at = words.find(phrase)
            while at >= 0:
                found.append((bisect_left(blanks, at), label))
                at = words.find(phrase, at + 1)
        return found

    def fuzzy(self, words: bytes, blanks: list[int] | None = None) -> list[tuple[int, int, str, float]]:
        """(first word, last word, label, similarity) of the verified notices."""
        blanks = places_of_blanks(words) if blanks is None else blanks
        found = []
        for notice, label, edits, seeds, pattern in self.notices:
            # an edit adds one character, of up to four bytes
            slack = 4 * edits + 1
            ranges = []
            for offset, seed in seeds:
                at = words.find(seed)
                while at >= 0:
                    ranges.append((max(0, at - offset - slack), min(len(words), at - offset + len(notice) + slack)))
                    at = words.find(seed, at + 1)
            for lo, hi in merged(ranges):
                for first, last, errors in stretches(pattern, words, lo, hi, len(notice) + 2 * slack):
                    found.append((bisect_left(blanks, first) - 1, bisect_left(blanks, last) - 1, label,
                                  1 - errors / len(notice)))
        return found


def places_of_blanks(words: bytes) -> list[int]:
    return [m.start() for m in re.finditer(rb" ", words)]


def stretches(pattern, words: bytes, lo: int, hi: int, longest: int):
    """(first byte, end byte, errors) of the matches in words[lo:hi].

    A long run of candidates is verified in stretches of a few lengths of a match, so its cost grows with
    its length.  A match that reaches into the last ``longest`` bytes of a stretch is left to the next one, which
    begins there or behind the last match taken.
    """
    while lo < hi:
        lo = whole_character(words, lo, 1)
        end = whole_character(words, min(hi, lo + STRETCH * longest), -1)
        if end <= lo:
            break
        window = words[lo:end].decode("utf-8", "replace")
        # byte offsets of the characters, where the window is not plain
        at = None if len(window) == end - lo else [0, *accumulate(len(c.encode()) for c in window)]
        limit = end if end >= hi - 3 else end - longest
        nearest = limit
        for start, stop, errors in places(pattern, window):
            first, last = (lo + start, lo + stop) if at is None else (lo + at[start], lo + at[stop])
            if last <= limit:
                yield first, last, errors
            elif first < limit:
                nearest = min(nearest, first)
        lo = hi if limit == end else nearest - 1 if nearest - 1 > lo else limit


def whole_character(words: bytes, at: int, step: int) -> int:
    """The nearest place from ``at`` on that is no inner byte of a character."""
    while 0 < at < len(words) and words[at] & 0xC0 == 0x80:
        at += step
    return at


def places(pattern, window: str) -> list[tuple[int, int, int]]:
    """(start, end, errors) of the best match, then of the best ones left and right of it, and so on."""
    found, todo = [], [(0, len(window))]
    while todo:
        lo, hi = todo.pop()
        m = pattern.search(window, lo, hi)
        if m and m.end() > m.start():
            found.append((m.start(), m.end(), sum(m.fuzzy_counts)))
            todo += [(lo, m.start()), (m.end(), hi)]
    return sorted(found)


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


SCAN = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
        "score double, spans array<struct<first_word:bigint,last_word:bigint,label:string,similarity:double>>")
_SPAN = pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("label", pa.string()),
                            ("similarity", pa.float64())]))


def scan_task(columns: list[str]):
    def run(batches):
        scanner = Scanner()
        for batch in batches:
            out: list[tuple] = []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                words = normalise(text)
                blanks = places_of_blanks(words)
                places, near = scanner.exact(words, blanks), scanner.fuzzy(words, blanks)
                base = sorted({label for _, label in places})
                every = sorted({*base, *(x[2] for x in near)})
                starts = [p for p, _ in places]
                spans = [dict(first_word=a, last_word=b, label=c, similarity=s) for a, b, c, s in sorted(near)]
                best = 1.0 if places else max((x[3] for x in near), default=0.0)
                out.append((len(blanks) - 1 if len(words) > 2 else 0, len(places), min(starts, default=None), max(starts, default=None),
                            ",".join(base), ",".join(every), best, spans))
            cols = list(zip(*out)) if out else [()] * 8
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), _SPAN]
            names = columns + [x.split()[0] for x in SCAN.split(", ")]
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1] + [pa.array(list(c), t) for c, t in zip(cols, kinds)], names)
    return run


def scan(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) per row."""
    plain = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return plain.mapInArrow(scan_task(["id"]), f"id {plain.schema['id'].dataType.simpleString()}, {SCAN}") \
        .withColumnRenamed("id", id_col)
