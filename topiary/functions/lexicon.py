"""Word lists and lookup tables.

Stop-word lists are not typed in here: they are the lists Spark ML ships
(``StopWordsRemover.loadDefaultStopWords``), read straight from the
spark-mllib jar so that plain Python (and the DuckDB oracle) can use the very
same words without a JVM.
"""

from __future__ import annotations

import functools
import glob
import os
import zipfile

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for equal results).
# Topic labels by topic id, as the reference hard-codes them for ten topics.
TOPIC_LABELS = {
    0: "Convergence",
    1: "State, Policy, Action",
    2: "Linear Algebra",
    3: "NLP",
    4: "Inference",
    5: "Computer Vision",
    6: "Graphical Models",
    7: "Neural Network Learning",
    8: "Stimulus Response",
    9: "Neural Network Structure",
}
# Unlabelled form of a topic name: "Topic {k}".
UNLABELLED_PREFIX = "Topic "
# ---------------------------------------------------------------------------

# Lemma lookup (our own small table standing in for a statistical
# lemmatizer): irregular English forms common in scientific prose. Tokens not
# listed keep their lower-cased surface form.
LEMMAS = {
    "data": "datum",
    "criteria": "criterion",
    "phenomena": "phenomenon",
    "analyses": "analysis",
    "hypotheses": "hypothesis",
    "matrices": "matrix",
    "indices": "index",
    "vertices": "vertex",
    "children": "child",
    "men": "man",
    "women": "woman",
    "feet": "foot",
    "teeth": "tooth",
    "mice": "mouse",
    "bound": "bind",
    "found": "find",
    "made": "make",
    "shown": "show",
    "taken": "take",
    "given": "give",
    "known": "know",
    "seen": "see",
    "chosen": "choose",
    "written": "write",
    "learnt": "learn",
    "learned": "learn",
    "learning": "learn",
    "better": "good",
    "best": "good",
    "larger": "large",
    "largest": "large",
    "smaller": "small",
    "smallest": "small",
    "higher": "high",
    "highest": "high",
    "lower": "low",
    "lowest": "low",
    "models": "model",
    "networks": "network",
    "results": "result",
    "methods": "method",
    "images": "image",
    "features": "feature",
    "algorithms": "algorithm",
    "studies": "study",
}

SPARK_LANGUAGES = {
    "en": "english", "fr": "french", "de": "german", "es": "spanish",
    "it": "italian", "pt": "portuguese", "nl": "dutch", "da": "danish",
    "fi": "finnish", "hu": "hungarian", "no": "norwegian", "ru": "russian",
    "sv": "swedish", "tr": "turkish",
}


def _mllib_jar() -> str | None:
    try:
        import pyspark
    except ImportError:  # pragma: no cover
        return None
    jars = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar"))
    return jars[0] if jars else None


@functools.lru_cache(maxsize=None)
def stop_words(language: str = "english") -> tuple[str, ...]:
    """Spark ML's default stop-word list for ``language`` (lower case)."""
    language = SPARK_LANGUAGES.get(language, language)
    jar = _mllib_jar()
    if jar is not None:
        with zipfile.ZipFile(jar) as z:
            raw = z.read(f"org/apache/spark/ml/feature/stopwords/{language}.txt").decode("utf-8")
        return tuple(w for w in raw.split() if w)
    from pyspark.ml.feature import StopWordsRemover  # needs an active JVM
    return tuple(StopWordsRemover.loadDefaultStopWords(language))


def title_forms(words) -> tuple[str, ...]:
    """Words plus their Title-case forms (the reference adds both)."""
    out = list(words)
    out += [w.title() for w in words]
    return tuple(dict.fromkeys(out))
