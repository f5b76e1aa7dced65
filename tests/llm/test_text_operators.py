"""Decontamination, secrets, token counts, chat, toxicity: brute force and round trips."""
import hashlib
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SMALL
from topiary.llm import chat, decontaminate, queries, secrets, token_counts, toxicity


def judged(got, docs, items):
    key = lambda r: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
    want = [((d, t), *decontaminate.brute_force([(0, t)], items)[0]) for d, t in docs]
    assert sorted(map(repr, (((r["doc_id"], r["text"]), *key(r)) for r in got))) == sorted(map(repr, want))


def test_decontaminate_brute_force(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    docs = [(1, None), (2, ""), (3, "x " + passage.upper() + " y " * 10), (4, " ".join(passage.split()[:12])),
            (5, "a b"), (6, "A-B a  b"), (7, passage + " " + passage), (7, passage), (None, "solo"), (8, "été " * 13),
            (9, "pre " * 400 + " ".join(passage.split()[5:18])), (10, "solo" * 90_000 + " solo"), (11, " ".join(passage.split()[-13:])),
            (12, "a a b a"), (13, "pre " + " ".join(passage.split()[-12:]) + " post")]
    items = [(1, passage), (1, "été " * 13), (2, "a b"), (3, None), (4, ""), (5, "solo"), (10, passage[:60]), (None, "a b a"), (11, "been \x00 there")]
    got = decontaminate.find(spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_words_", F.lit(1)),
                             spark.createDataFrame(items, "item_id long, text string"))
    assert got.columns == ["doc_id", "text", "n_words_", *decontaminate.ADDED]
    judged(got.collect(), docs, items)


def test_decontaminate_random(spark):
    """Few words, so that windows overlap, prefixes are shared and most candidates are none."""
    r = random.Random(5)
    said = lambda n, words: " ".join(f"w{int(words * r.random() ** 2)}" for _ in range(n))
    items = [(i, said(r.choice([1, 2, 3, 12, 13, 40]), 30)) for i in range(60)] + [(i, "tail " * 14) for i in range(60)]
    docs = [(i, said(r.randrange(5), 30) + " " + t + " post " + said(r.randrange(60), 30)) for i, t in items[::7]]
    docs += [(100 + i, said(80, 30)) for i in range(20)] + [(900, "clean text"), (901, None)] + [(200 + i, docs[0][1]) for i in range(50)]
    judged(decontaminate.find(spark.createDataFrame(docs, "doc_id long, text string"),
                              spark.createDataFrame(items, "item_id long, text string")).collect(), docs, items)


def test_decontaminate_replaces_columns_of_its_names(spark):
    docs = spark.createDataFrame([(1, "a b", 7, "x", "y")], "__key long, text string, n_words int, __digest string, window string")
    none = spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame([(5, "b")], "item_id long, text string")
    for keep in (None, docs.columns):
        got = decontaminate.find(docs, none, keep=keep)
        assert got.columns == ["__key", "text", "__digest", "window", *decontaminate.ADDED]
        assert (got.first()["n_words"], got.first()["__digest"]) == (2, "x")
        assert decontaminate.find(docs, items, keep=keep).first()["n_hit"] == 1


def test_decontaminate_empty(spark, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find(empty, none).count() == 0
    assert decontaminate.find(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), none).first()["n_hit"] == 0


@given(st.lists(st.sampled_from(["token", "=", ": ", "'", "secret", "AKIA", "A" * 16, "0af", "deadbeef" * 4, "x", "é", "K", "ſecret:abcdefg", "a1B2" * 8]), max_size=12))
@settings(max_examples=300, deadline=None)
def test_secret_base_rules(parts):
    text = "".join(parts)
    spans = [s for s in secrets.scan_text(text) if s[2] != "entropy"]
    digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in spans).encode()).hexdigest()
    count = lambda k: sum(s[2] == k for s in spans)
    assert (count("assign"), count("access"), count("hex"), digest) == secrets.brute_force(text)


def test_entropy_spans():
    import math
    from collections import Counter
    s = "Zk3J9xQ7vW1mT5rY8bN2"
    bits = -sum(c / 20 * math.log2(c / 20) for c in Counter(s).values())
    assert bits > 3.8 and list(secrets.window_spans(s)) == [(0, 20)]
    assert [k for *_, k in secrets.scan_text(f"see {s} there")] == ["entropy"]
    for calm in ("aaaaaaaaaaaaaaaaaaaaaaaa1", "123e4567-e89b-12d3-a456-426614174000", "some/long/path/to/readme", "12345678901234567890123"):
        assert "entropy" not in [k for *_, k in secrets.scan_text(calm)]
    # incremental counts equal counting anew
    t = "aB3" * 9 + s + "zzzzzzzzzzzzzzzzzzzzzz9" + s
    hot = set()
    for i in range(len(t) - 19):
        if -sum(c / 20 * math.log2(c / 20) for c in Counter(t[i:i + 20]).values()) >= 3.8:
            hot.update(range(i, i + 20))
    token_only = {i for a, b in secrets.window_spans(t) for i in range(a, b)}
    assert hot <= token_only


#: Class -> (characters, least share found of planted random keys of 32 characters, 22 for digits: longer ones are base rule hex).
PLANTED = {"digits": ("0123456789", 0.95), "hex": ("0123456789ABCDEF", 0.95), "lower": ("abcdefghijklmnopqrstuvwxyz", 0.85),
           "upper": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 0.85), "letters": ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 0.99),
           "base64": ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", 0.99)}


def test_planted_keys_of_each_class():
    r, n = random.Random(3), 400
    for name, (chars, least) in PLANTED.items():
        hits = 0
        for _ in range(n):
            key = "".join(r.choice(chars) for _ in range(22 if name == "digits" else 32))
            spans = [s for s in secrets.scan_text(f"see {key} there") if s[2] == "entropy"]
            assert all(4 <= a < b <= 4 + len(key) for a, b, _ in spans)
            hits += bool(spans)
        assert hits >= least * n, (name, hits)


def test_allow_list():
    calm = ["Zk3J9xQ7vW1mT5rY8bN2.png", "https://example.org/2020/03/how-a-small-town-of-rivers-was-saved-in-2019", "src/main/java/ApplicationContextFactory",
            "123e4567-e89b-12d3-a456-426614174000", "01234567890123456789", "internationalizationAndLocalization", "==========================",
            "donaudampfschifffahrtsgesellschaft", "MAXIMUM_ALLOWED_CONNECTIONS_2", "chapter12/section03/paragraph0041"]
    for text in calm:
        assert secrets.scan_text(f"see {text} there") == [], text
    assert [k for *_, k in secrets.scan_text("a key qzXvTbNmKjHgFdRwPlCsYtWbVq without a digit")] == ["entropy"]
    assert [k for *_, k in secrets.scan_text("Zk3J9xQ7vW1mT5rY8bN2.pngx")] == ["entropy"]  # no known extension


def test_entropy_adds_few_spans_to_prose(spark):
    rows = [r[0] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()]
    words = sum(len((t or "").split()) for t in rows)
    found = sum(s[2] == "entropy" for t in rows for s in secrets.scan_text(t or ""))
    assert found * 10_000 <= words


def test_secret_scan_is_linear():
    import time
    began = time.monotonic()
    for text in ("a" * 300_000 + "B!", "deadbeef" * 20_000 + "X", "ab1" * 80_000 + "!", "token" * 50_000):
        secrets.scan_text(text)
    assert time.monotonic() - began < 20


def test_secrets_awkward(awkward, empty):
    assert secrets.scan(empty).count() == 0
    got = secrets.scan(awkward).collect()
    assert len(got) == awkward.count()
    for r in got:
        assert [tuple(s) for s in r["secret_spans"]] == secrets.scan_text(r["text"] or "")


def test_token_counts_equal_the_library(spark, small_docs, awkward, empty):
    t = token_counts.load(token_counts.default_path())
    texts = [x or "" for _, x in small_docs] + ["it's  a\t\ttest\n\n x", "<|endoftext|> a", "naïve ½ ²", "日本 語", "a b\u0085c", "'S 's", " "]
    counts = token_counts.Counts(token_counts.default_path(), {" the": 1})
    assert counts.of(texts) == [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]
    got = token_counts.count(awkward, size=50).collect()
    for r in got:
        x = r["text"] or ""
        assert (r["n_bytes"], r["n_tokens"]) == (len(x.encode()), len(t.encode(x, add_special_tokens=False).ids))
    assert token_counts.count(empty).count() == 0


@given(st.text(alphabet="\\#< /turn>\nRole: asx", max_size=40), st.text(alphabet="\\#< /turn>\nRole: asx", max_size=12))
@settings(max_examples=400, deadline=None)
def test_chat_round_trip(text, role):
    f = chat.format_turn(role, text) + chat.format_turn("assistant", text)
    assert [(r, t) for r, t, *_ in chat.parse(f)] == [(role, text), ("assistant", text)]
    (_, _, a, b) = list(chat.parse(f))[1]
    assert chat.unescape(f[a:b]) == text


def test_chat_layouts(spark):
    records = [
        {"conv_id": 1, "turn": 0, "role": "user", "text": "hi"},
        {"id": 2, "messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]},
        {"id": 3, "conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": None}]},
        {"id": 4, "prompt": "p", "response": "r"}, {"id": 5, "instruction": "i", "input": "", "output": "o"},
        {"id": 6, "system": "s", "instruction": "i", "input": "x", "output": "o"}, {"id": 7, "what": 1}, [1]]
    df = spark.createDataFrame([(json.dumps(r),) for r in records] + [(None,), ("{",)], "record string")
    rows = chat.canonical_turns(df).collect()
    got = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows if r["known"]]
    assert got == [(1, 0, "user", "hi"), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (3, 0, "user", "a"), (3, 1, "assistant", ""),
                   (4, 0, "user", "p"), (4, 1, "assistant", "r"), (5, 0, "user", "i"), (5, 1, "assistant", "o"),
                   (6, 0, "system", "s"), (6, 1, "user", "i\n\nx"), (6, 2, "assistant", "o")]
    assert sum(not r["known"] for r in rows) == 4


def test_chat_query(spark):
    rows = queries.QUERIES["op8_chat_format"](spark, SMALL).collect()
    source = spark.read.parquet(f"{SMALL}/conversations.parquet").orderBy("conv_id", "turn").collect()
    turns: dict = {-7: [("user", queries.TRAP), ("assistant", queries.TRAP)]}
    for r in source:
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    assert len(rows) == len(turns)
    for r in rows:
        own = turns[r["conv_id"]]
        said = "".join(t for role, t in own if role == "assistant")
        assert r["n_turns"] == len(own) and r["loss_chars"] == len(said)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()


def edit_distance_at_most_one(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + 1:] == b[i + 1:] or a[i:] == b[i + 1:] or a[i + 1:] == b[i:]


@given(st.text(alphabet="abmorn", min_size=1, max_size=7))
@settings(max_examples=500, deadline=None)
def test_automaton_is_the_edit_distance(word):
    terms = ["moron", "barn", "mamba"]
    lexicon = toxicity.Lexicon(terms)
    exact, near = word in terms, any(len(t) >= toxicity.FUZZY_FROM and edit_distance_at_most_one(word, t) for t in terms)
    assert lexicon.match(word) == (3 if exact else 1 if near else 0)


def test_lexicon_stems_lookalikes_and_clean_words():
    lexicon = toxicity.Lexicon(["lowei*", "idiot", "scum"], clean=["idiom"])
    assert [lexicon.match(w) for w in ("loweix", "lowe", "1d10t", "idiom", "idiota", "scun", "$cum")] == [2, 0, 3, 0, 1, 0, 3]


def test_context_separates_quotation():
    lexicon = toxicity.Lexicon(["idiot", "scum"])
    plain, quoted, report = (toxicity.features(t, lexicon) for t in (
        "you are an idiot and scum", 'the sign held an "idiot" there', "he wrote the word idiot in a report"))
    assert plain[1] > report[1] and plain[1] > quoted[1]
    assert toxicity.features("", lexicon) == [0.0] * 6


def test_toxicity_learns_held_out(spark, awkward, empty):
    import random
    r = random.Random(5)
    vocabulary = ["".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(400)]
    bad = ["vilgor", "drunkel", "moskar"]
    docs, labels = [], []
    for i in range(900):
        words = [r.choice(vocabulary) for _ in range(r.randint(20, 80))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(4):
                words.insert(r.randrange(len(words)), r.choice(bad))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    la = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(d, la)
    assert set(bad) <= set(model.terms)
    got = toxicity.score(d, model).withColumn("held", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).collect()
    held = [(x["toxicity"] >= 0.5, x["doc_id"] % 6 == 0) for x in got if x["held"]]
    assert len(held) > 100 and sum(a == b for a, b in held) / len(held) > 0.97
    assert toxicity.score(awkward, model).count() == awkward.count()
    assert toxicity.score(empty, toxicity.fit(empty, la.limit(0))).count() == 0


def test_clean_words_near_a_term_are_all_kept(spark):
    near = sorted({"grimbolt"[:k] + c + "grimbolt"[k + 1:] for k in range(8) for c in "qxzjvw"} | {"grimbolt" + c for c in "abcdefgh"})
    rows = [("grimbolt", 1)] * 40 + [(w, 0) for w in near]
    train = spark.createDataFrame(rows, "text string, toxic int")
    terms, clean = toxicity.learn_terms(train, {0: len(near), 1: 40}, max_terms=1)
    assert terms == ["grimbolt"] and clean == near and len(near) > 50
