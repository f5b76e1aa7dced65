"""Scalar text functions (Column -> Column), all JVM built-ins.

They stay inside whole-stage code generation: no Python UDF, no regex where a
plain string function does the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from topiary.functions.lexicon import TOPIC_LABELS, UNLABELLED_PREFIX


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- C1: metadata from a path  files/pdf/<journal>/<year>/<name>.pdf --------

def path_journal(path) -> Column:
    return F.get(F.split(_col(path), "/"), 2)


def path_year(path) -> Column:
    return F.get(F.split(_col(path), "/"), 3)


def path_title(path) -> Column:
    """Segment 4 with '-' -> ' ', first and last four characters chopped, trimmed."""
    seg = F.replace(F.get(F.split(_col(path), "/"), 4), F.lit("-"), F.lit(" "))
    return F.trim(seg.substr(F.lit(5), F.greatest(F.length(seg) - 8, F.lit(0))))


# --- C2..C8: full-text clean-up ---------------------------------------------

# Soft hyphen, em dash, en dash and minus sign all become "-".
DASHES = "­—–−"
# Ligature characters and their expansions, in the order applied.
LIGATURES = (("ﬂ", "fl"), ("ﬁ", "fi"), ("ﬀ", "ff"), ("ﬃ", "ffi"), ("ﬄ", "ffl"))


def unify_dashes(c) -> Column:
    # replace() returns its input untouched when the character is absent,
    # while translate() rebuilds every string code point by code point.
    out = _col(c)
    for ch in DASHES:
        out = F.replace(out, F.lit(ch), F.lit("-"))
    return out


def dehyphenate(c) -> Column:
    return F.replace(_col(c), F.lit("-\n"), F.lit(""))


def unwrap_lines(c) -> Column:
    return F.replace(_col(c), F.lit("\n"), F.lit(" "))


def expand_ligatures(c) -> Column:
    out = _col(c)
    for lig, repl in LIGATURES:
        out = F.replace(out, F.lit(lig), F.lit(repl))
    return out


def cut_before_last(c, marker: str) -> Column:
    """Keep the text before the last ``marker`` if that occurrence is not at 0.

    ``substring_index(c, m, -1)`` is the text after the last occurrence, so the
    occurrence starts at ``length(c) - length(tail) - length(m)`` (negative
    when absent). No regex, one scan.
    """
    c = _col(c)
    tail = F.substring_index(c, marker, -1)
    pos = F.length(c) - F.length(tail) - F.lit(len(marker))
    return F.when(pos > 0, F.left(c, pos)).otherwise(c)


def cut_references(c) -> Column:
    return cut_before_last(c, "References")


def cut_acknowledgment(c) -> Column:
    return cut_before_last(c, "Acknowledgment")


def clean_fulltext(c) -> Column:
    """C2 -> C3 -> C4 -> C5 -> C6 -> C7, in the reference's order."""
    out = unify_dashes(c)
    out = dehyphenate(out)
    out = unwrap_lines(out)
    out = expand_ligatures(out)
    out = cut_references(out)
    return cut_acknowledgment(out)


def strip_boilerplate(c, pattern: str | None = None, first_n_chars: int = 0) -> Column:
    """Drop a publisher pattern and/or the first n characters."""
    out = _col(c)
    if pattern:
        out = F.regexp_replace(out, F.lit(pattern), F.lit(""))
    if first_n_chars:
        out = out.substr(F.lit(first_n_chars + 1), F.greatest(F.length(out) - first_n_chars, F.lit(0)))
    return out


# --- C9..C13 ------------------------------------------------------------------

def normalize_case(c, mode: str = "lower") -> Column:
    c = _col(c)
    return {"lower": F.lower, "upper": F.upper, "title": F.initcap}[mode](c)


def cast_year(c, strict: bool = True) -> Column:
    c = _col(c)
    return c.cast("int") if strict else c.try_cast("int")


def format_prob(p) -> Column:
    """3-decimal probability with every '0.' replaced by '.' (".042")."""
    return F.replace(F.format_string("%.3f", _col(p)), F.lit("0."), F.lit("."))


def topic_label(topic_id, labels_available: bool = True, strict: bool = True) -> Column:
    """Label by id from the fixed table; 'Topic {k}' when labels are off.

    The table is ten literals, so the lookup is a CASE expression, not a join.
    In strict mode an unknown id raises, as the reference's dict lookup does.
    """
    t = _col(topic_id)
    if not labels_available:
        return F.concat(F.lit(UNLABELLED_PREFIX), t.cast("string"))
    expr = None
    for k, v in TOPIC_LABELS.items():
        expr = (F.when(t == k, F.lit(v)) if expr is None else expr.when(t == k, F.lit(v)))
    if strict:
        return expr.otherwise(F.raise_error(F.concat(F.lit("unknown topic id "), t.cast("string"))).cast("string"))
    return expr


def row_label_pct(label, value) -> Column:
    """'{label} ({round(value, 2)}%)'."""
    return F.concat(_col(label), F.lit(" ("), F.round(_col(value), 2).cast("string"), F.lit("%)"))


def mask_nonpositive(c) -> Column:
    """Hide cells <= 0 (NULL)."""
    c = _col(c)
    return F.when(c > 0, c)
