"""Secret scans: fixed rules plus sliding-window entropy.

Base rules (kinds ``assign``, ``access``, ``hex``) are leftmost, non-overlapping
matches per kind; a match that is too short is dropped after matching, as it
still takes its place.

The entropy rule adds spans of kind ``entropy``. Candidate strings are long runs
of token characters. For each character class (``CLASSES``) a window slides through
the candidate's runs of that class; its Shannon entropy is kept from incremental
counts, one character in and one out, as sum(c * log2 c). The windows that reach
their class's threshold, merged over the classes, are reported, unless the
allow-list suppresses the candidate (``allowed``): hyphenated UUIDs, file names with a
known extension, strings whose parts between separators all read like words or short
numbers (paths, article addresses, identifiers in camel case), numbers that count up or
down, and digests that a base rule reports already. A part reads like a word if its
letters, cut at capitals, come in humps of three or more with vowels among them and no five
consonants (sch, ch, ck, th are one, h after a vowel is none) in a row; no word list is asked, so a random key that passes for
syllables is missed (tests state the recall by class).

Spans are code points, end exclusive. Defined cases: NULL and empty texts give
zero counts and empty lists; repeated rows are scanned one by one; columns
other than ``text`` pass through unread. A text is scanned whole in one pass,
linear in its length.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

KINDS = ("assign", "access", "hex", "entropy")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ that are long enough: a run is one match either way
_KEYWORDS = ("passw", "secret", "token", "key")

WINDOW = 20
#: Class -> (its runs, least entropy in bits of a window of WINDOW characters: some 99 of 100
#: windows of random characters of the class reach it, 95 of 100 for ``token``).
CLASSES = {"digits": ("[0-9]", 2.5), "hex": ("[0-9a-fA-F]", 2.9), "lower": ("[a-z]", 3.2), "upper": ("[A-Z]", 3.2),
           "base64": ("[A-Za-z0-9+/]", 3.65), "token": ("[A-Za-z0-9+/_=-]", 3.8)}
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}")
_UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_RUNS = {name: (re.compile(f"{chars}{{{WINDOW},}}"), least) for name, (chars, least) in CLASSES.items()}
#: Extensions of file names on the allow-list.
EXTENSIONS = ("avi", "bin", "bmp", "css", "csv", "doc", "docx", "gif", "gz", "htm", "html", "ico", "jpeg", "jpg", "js", "json", "md", "mov",
              "mp3", "mp4", "pdf", "php", "png", "ppt", "py", "svg", "tar", "tif", "txt", "wav", "webp", "xls", "xlsx", "xml", "zip")
_EXTENSION = re.compile(rf"\.(?:{'|'.join(EXTENSIONS)})(?![A-Za-z0-9_-])", re.I)
_SEPARATORS = re.compile(r"[+/_=-]+")
_NUMBER = re.compile(r"[0-9]{1,8}")
_WORD = re.compile(r"([A-Za-z]+)[0-9]{0,4}")
_HUMP = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_VOWEL = re.compile(r"[aeiouyAEIOUY]")
_CONSONANTS = re.compile(r"(?>sch|ch|ck|th|(?<![aeiouy])h|[b-dfgj-np-tv-xz]){5}", re.I)  # five sounds; an h after a vowel is none
_BITS = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def _plain(part: str) -> bool:
    """A short number, or letters that read like words, up to four digits behind them."""
    if _NUMBER.fullmatch(part):
        return True
    m = _WORD.fullmatch(part)
    if m is None:
        return False
    letters = m.group(1)
    if len(letters) <= 3:
        return True
    humps = _HUMP.findall(letters)
    return (min(map(len, humps)) >= 3 and 5 * len(_VOWEL.findall(letters)) >= len(letters) and _CONSONANTS.search(letters) is None)


def _counting(s: str) -> bool:
    """Digits that mostly step by one value: 0123..., 9876..., 0000..."""
    steps = [(ord(b) - ord(a)) % 10 for a, b in zip(s, s[1:])]
    return 2 * max(map(steps.count, range(10))) >= len(steps)


def allowed(s: str) -> bool:
    """On the allow-list: cannot be a secret although it may look random."""
    if s.isdigit():
        return _counting(s)
    return _UUID.fullmatch(s) is not None or all(_plain(p) for p in _SEPARATORS.split(s) if p)


def _class_spans(s: str, name: str) -> Iterator[tuple[int, int]]:
    """Spans of the windows of one class that reach its threshold, merged where they meet."""
    runs, least = _RUNS[name]
    most = WINDOW * (math.log2(WINDOW) - least)  # entropy = log2 W - sum(c log2 c) / W
    for run in runs.finditer(s):
        counts, total, found = {}, 0.0, None
        for i in range(run.start(), run.end()):
            if i - run.start() >= WINDOW:
                out = s[i - WINDOW]
                k = counts[out]
                total += _BITS[k - 1] - _BITS[k]
                counts[out] = k - 1
            k = counts.get(s[i], 0)
            total += _BITS[k + 1] - _BITS[k]
            counts[s[i]] = k + 1
            begin = i - WINDOW + 1
            if begin >= run.start() and total <= most:
                if found and begin <= found[1]:
                    found = (found[0], i + 1)
                else:
                    if found:
                        yield found
                    found = (begin, i + 1)
        if found:
            yield found


def window_spans(s: str) -> list[tuple[int, int]]:
    """The classes' spans, merged where they meet."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(span for name in CLASSES for span in _class_spans(s, name)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def scan_text(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), sorted by start, then kind as listed in KINDS."""
    out = []
    lower = text.lower()
    if any(k in lower for k in _KEYWORDS):
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    base = out[:]
    for m in _CANDIDATE.finditer(text):
        s = m.group()
        if any(a <= m.start() and m.end() <= b for a, b, _ in base) or _EXTENSION.match(text, m.end()) or allowed(s):
            continue
        for a, b in window_spans(s):
            span = (m.start() + a, m.start() + b, "entropy")
            if not any(x <= span[0] and span[1] <= y for x, y, _ in base):
                out.append(span)
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def scan(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (needs ``text``), or only its columns ``keep``, with
    ``secret_spans``: array of (start, end, kind)."""
    keep = docs.columns if keep is None else keep
    docs = docs.select(*dict.fromkeys([*keep, "text"]))
    kind = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                                     T.StructField("kind", T.StringType())]))
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("secret_spans", kind)])
    at = docs.columns.index("text")
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"start": a, "end": b, "kind": k} for a, b, k in scan_text(t.as_py() or "")] for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(found, spans)], [*keep, "secret_spans"])

    return docs.mapInArrow(find, schema)


def brute_force(text: str) -> tuple:
    """(n_assign, n_access, n_hex, base_sha256) straight from the rules."""
    spans = [(m.start(), 0, m.end()) for m in re.finditer(_ASSIGN.pattern, text, re.I | re.A) if len(m.group(2)) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    joined = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
    return (*(sum(s[1] == k for s in spans) for k in range(3)), hashlib.sha256(joined.encode()).hexdigest())
