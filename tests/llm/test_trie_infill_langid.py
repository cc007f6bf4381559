"""Prefix trie, fill-in-middle and language identification against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stationwise.llm import infill, langid, trie

TURNS = "conv_id long, turn long, role string, text string, n_convs string, path int"


def _conversations():
    rng = random.Random(5)
    first = [("system", "be kind"), ("user", "hello there"), ("assistant", "hi")]
    out = []
    for c in [*range(0, 47), 60, 61, 81, 95, -7, -20, 400]:
        n = rng.choice([1, 1, 2, 3, 4, 6])
        same = first if c % 3 == 0 else []  # a third of all begin alike
        turns = [*same, *(("user", f"w{rng.randrange(3)} x") for _ in range(n))][: max(n, len(same))]
        out += [(c, i, *t, "extra", 1) for i, t in enumerate(turns)]
    out += [(200, None, "user", "null turn", "x", 1), (200, None, None, None, "x", 1), (200, 3, "user", "ü  ö", "x", 1), (200, 3, "user", "ü  ö", "x", 1)]
    out += [(None, 0, "user", "nobody", "x", 1), (223, 0, "user", "alone", "x", 1)]  # 223 borrows from 220, which is absent
    out += [(500 + i, j, "user", f"same {j}", "x", 1) for i in range(30) for j in range(40)]
    rng.shuffle(out)
    return out


def _key(role, text):
    role, text = (role or "").encode(), (text or "").encode()
    return hashlib.md5(str(len(role)).encode() + b":" + role + text).digest()


def _brute(rows, rebuild=True):
    convs: dict = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, _key(role, text), (role or "", text or "")))
    convs = {c: [x[3] for x in sorted(v)] for c, v in convs.items()}
    if rebuild:
        made = {}
        for c, own in convs.items():
            h = zlib.crc32(str(c).encode()) % 4
            base = c - int(np.fmod(c, 20))
            made[c] = convs.get(base, [])[:h] + own[h:]
        convs = made
    members: dict = {}
    for c, s in convs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    kids: dict = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    out = []
    for p, m in members.items():
        under = [q for q in members if q[: len(p)] == p]
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        saved = sum((len(members[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in under if q)
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), sum(q not in kids for q in under), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@pytest.mark.parametrize("shard_turns", [100_000, 60])
def test_trie_equals_brute_force(spark, shard_turns):
    rows = _conversations()
    conversations = spark.createDataFrame(rows, TURNS).repartition(4)
    turns = trie.ordered_turns(conversations)
    got = trie.prefix_trie(trie.rebuilt_turns(turns), shard_turns).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=repr) == _brute(rows)
    # without rebuilding, and dealt by a column
    plain = trie.prefix_trie(turns, shard_turns, F.col("conv_id") % 3).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in plain), key=repr) == _brute(rows, rebuild=False)
    texts = {bytes(r["key"]) for r in trie.turn_texts(conversations).collect()}
    assert {bytes(r["key"]) for r in plain if r["key"]} <= texts
    assert {bytes(r["parent"]) for r in got if r["parent"]} <= {bytes(r["path"]) for r in got}


def test_trie_of_nothing(spark):
    assert trie.prefix_trie(trie.rebuilt_turns(trie.ordered_turns(spark.createDataFrame([], TURNS)))).count() == 0


def test_end_lists_in_pieces(monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 7)
    rows = [(b"a", 1), (b"a", 20), (b"a", 300), (b"a", 4000), (b"b", -5)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64())], names=["path", "conv_id"])
    pieces = list(trie._pieces(iter([batch])))
    assert len(pieces) > 2
    found = {p: d for b in trie._digests(iter(pieces)) for p, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)}
    assert found == {b"a": hashlib.sha256(b"1,20,300,4000").hexdigest(), b"b": hashlib.sha256(b"-5").hexdigest()}


TEXTS = [None, "", " ", "a", "é", "a b", " a  b ", "\n x y ", "日本 語\tas 𝔘nicode  end  ", "one <P> two", "x<", "<S", "tail<M", "ascii only words here", "ü" * 300 + " " + "x" * 500, "é" + " w" * 40_000]
DOCS = "doc_id long, text string, lang string, form string, draws int, restored int, n_units int, lang_pred string"


def _docs(spark):
    rows = [(i if i else None, TEXTS[i % len(TEXTS)], "en", "x", 1, 2, 3, "y") for i in range(len(TEXTS) * 12)]
    return rows, spark.createDataFrame(rows + rows[3:5], DOCS).repartition(3)


@pytest.mark.parametrize("unit", ["token", "point", "byte"])
def test_fill_in_middle_equals_brute_force(spark, unit):
    rows, docs = _docs(spark)
    made = infill.restore(infill.fill_in_middle(docs, unit=unit), form="form_")
    got = made.collect()
    assert len(got) == len(rows) + 2 and made.columns[: len(docs.columns)] == docs.columns
    forms = set()
    for r in got:
        text = r["text"] or ""
        digest = hashlib.sha256(f"42:{'' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
        tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
        n = len(tokens) if unit == "token" else len(text) if unit == "point" else len(text.encode())
        assert r["n_units_"] == n and r["restored_"] == text
        forms.add(r["form_"])
        if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
            assert r["form_"] == "plain" and r["output"] == text and r["prefix_chars"] is None and r["middle_chars"] is None
            continue
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        if unit == "token":
            prefix, middle = "".join(tokens[:a]), "".join(tokens[a:b])
        elif unit == "point":
            prefix, middle = text[:a], text[a:b]
        else:  # a byte cut inside a character moves to its begin
            prefix = text.encode()[:a].decode("utf-8", "ignore")
            middle = text.encode()[:b].decode("utf-8", "ignore")[len(prefix) :]
        suffix = text[len(prefix) + len(middle) :]
        spm = h4 % 100 < 80
        assert r["form_"] == ("spm" if spm else "psm")
        assert r["output"] == (f"<S>{suffix}<P>{prefix}<M>{middle}" if spm else f"<P>{prefix}<S>{suffix}<M>{middle}")
        assert (r["prefix_chars"], r["middle_chars"]) == (len(prefix), len(middle))
    assert forms == {"plain", "spm", "psm"}


def test_fill_in_middle_of_other_bytes(spark):
    docs = spark.sql("select id as doc_id, cast(unhex('61ff62208020c3') as string) as text from range(40)")
    made = infill.restore(infill.fill_in_middle(docs)).selectExpr("form", "hex(restored) as back").distinct().collect()
    assert {r["back"] for r in made} == {"61FF62208020C3"} and len({r["form"] for r in made}) > 1
    assert infill.fill_in_middle(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        infill.fill_in_middle(docs, unit="line")


def test_exception_index():
    text = "aé日𝔘z" * 3
    index = infill.Exceptions(text.encode())
    places = np.array([len(text[:i].encode()) for i in range(len(text) + 1)])
    assert len(index) == len(text) and len(index.at) == 9
    assert index.points(places).tolist() == list(range(len(text) + 1))
    assert index.places(np.arange(len(text) + 1)).tolist() == places.tolist()


def _phrases(train: bytes, text: bytes) -> int:
    n = 0
    for at in range(0, len(text), langid.STRETCH):
        part = text[at : at + langid.STRETCH]
        while part:
            k = 1
            while k < len(part) and part[: k + 1] in train:
                k += 1
            part, n = part[k:], n + 1
    return n


def test_phrases_equal_brute_force(monkeypatch):
    monkeypatch.setattr(langid, "STRETCH", 37)
    rng = random.Random(2)
    make = lambda letters, n: "".join(rng.choice(letters) for _ in range(n)).encode()
    training = [("a", make("ab c", 400) + b"\0" + make("abd", 90)), ("b", make("xyzé ", 300)), ("c", b"q")]
    texts = [make("abcxyzé 語", n) for n in (1, 2, 36, 37, 38, 200)] + [training[0][1][5:80].replace(b"\0", b" "), b"q"]
    languages = langid.Languages(training)
    got = languages.phrases(texts)
    assert got.tolist() == [[_phrases(train, t) for t in texts] for _, train in training]
    assert languages.rank([b"q", None, b"12 34", "日".encode()])[0][0] == "c"
    assert languages.rank([None, b"12 . 34"]) == [("und", 0.0)] * 2


def test_language_edge_cases(spark):
    rows, docs = _docs(spark)
    english = "the quick brown fox jumps over the lazy dog and runs away from the house "
    german = "der schnelle braune Fuchs springt über den faulen Hund und läuft aus dem Haus "
    training = spark.createDataFrame([(1, english * 4, "en"), (2, german * 4, "de"), (3, None, "fr"), (4, "12 34", "it"), (5, english, None)], "doc_id long, text string, lang string")
    texts = langid.training_texts(training)
    assert [n for n, _ in texts] == ["de", "en"]
    got = langid.identify(docs, texts).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        if not re.search(r"[^\W\d_]", r["text"] or ""):
            assert (r["lang_pred_"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred_"] in ("de", "en") and 0 <= r["score"] <= 1
    few = spark.createDataFrame([("Der Hund und das Haus",), ("the dog and the house",), ("DER HUND",)], "text string")
    assert [r["lang_pred"] for r in langid.identify(few, texts).collect()] == ["de", "en", "de"]
    assert [r["score"] for r in langid.identify(few, texts[:1]).collect()] == [1.0] * 3
    nothing = langid.identify(few, langid.training_texts(training.limit(0)))
    assert [tuple(r) for r in nothing.select("lang_pred", "score").collect()] == [("und", 0.0)] * 3
    assert langid.identify(few.limit(0), texts).count() == 0


def test_training_rows_are_whole_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(langid, "TRAIN_BYTES", 1000)
    rows = [(i, f"word{chr(97 + i % 26)} " * (20 + i), "en") for i in range(60)] + [(900 + i, "lang " * (500 + i), "long") for i in range(3)]
    texts = dict(langid.training_texts(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    assert 0 < len(texts["en"]) <= 1000
    whole = {langid.normal(t.encode()) for _, t, _ in rows}
    assert all(t in whole for t in texts["en"].split(b"\0"))
    assert texts["long"] == langid.normal(b"lang " * 500)  # longer rows only: the shortest


def test_language_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = langid.op13_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out").collect()
    assert len(rows) > 100 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) >= 0.97
